"""WARC records in seekable Zstandard bundles.

A bundle is one file: independent Zstandard frames of several records each, a
skippable frame that maps record ids to (frame, offset in the frame, length),
and the seek table of the Zstandard seekable format as footer. A plain ``zstd``
decoder reads a bundle as one WARC file; ``fetch`` reads single records by
decompressing only their frames.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import fresh_path, query, table

# Zstandard skippable frames and the seekable format's footer.
SKIPPABLE_SEEK, SKIPPABLE_INDEX = 0x184D2A5E, 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
#: Records of smaller payloads are never made revisits.
MIN_REVISIT_BYTES = 1000
#: Uncompressed bytes after which a frame ends; compressed bytes after which a
#: bundle ends.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 32 << 20
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(page_id) -> str:
    return "<urn:x-page:%s>" % ("null" if page_id is None else int(page_id))


def _page(urn: str) -> int | None:
    value = urn.strip("<>").rpartition(":")[2]
    return None if value == "null" else int(value)


def _header_safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), url)


def format_record(page_id, url: str | None, payload: bytes, size: int, sha1_hex: str, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header and no payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if revisit else http + payload
    head = ["WARC/1.1", "WARC-Type: " + ("revisit" if revisit else "response"), "WARC-Record-ID: " + _urn(page_id),
            "WARC-Date: " + _DATE]
    if url is not None:
        head.append("WARC-Target-URI: " + _header_safe(url))
    if revisit:
        head += ["WARC-Refers-To: " + _urn(refers_to), "WARC-Profile: " + _PROFILE]
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    head += ["WARC-Payload-Digest: sha1:" + digest, "Content-Type: application/http;msgtype=response",
             "Content-Length: %d" % len(block)]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one record; a response's payload is measured and hashed,
    a revisit's size and digest are those its headers state."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].partition(":")[2]).hex()
    kind = fields["WARC-Type"]
    if kind == "response":
        size, found = len(payload), hashlib.sha1(payload).hexdigest()
        if found != digest:
            raise ValueError(f"payload digest of {fields['WARC-Record-ID']} differs")
    else:
        size, payload = int(re.search(rb"Content-Length: (\d+)", http)[1]), b""
    refers = fields.get("WARC-Refers-To")
    return {"page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "payload": payload, "payload_bytes": size, "payload_digest": digest,
            "refers_to": None if refers is None else _page(refers)}


class Bundle:
    """Collects records into one seekable bundle."""

    def __init__(self):
        self.zstd = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.frames: list[bytes] = []
        self.seek: list[tuple[int, int]] = []
        self.index: list[tuple] = []
        self.open, self.open_bytes, self.size = [], 0, 0

    def add(self, page_id, record: bytes) -> None:
        self.index.append((page_id, len(self.frames), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)
        if self.open_bytes >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if self.open:
            frame = self.zstd.compress(b"".join(self.open))
            self.frames.append(frame)
            self.seek.append((len(frame), self.open_bytes))
            self.size += len(frame)
            self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        self.end_frame()
        listing = self.zstd.compress(json.dumps(self.index, separators=(",", ":")).encode())
        entries = self.seek + [(len(listing) + 8, 0)]  # the index frame holds no content
        table_ = b"".join(struct.pack("<II", *e) for e in entries) + struct.pack("<IBI", len(entries), 0, SEEKABLE_MAGIC)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE_INDEX, len(listing)) + listing \
            + struct.pack("<II", SKIPPABLE_SEEK, len(table_)) + table_


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, content size) of every frame before the footer."""
    count, _, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    at, out = 0, []
    for i in range(count):
        packed, size = struct.unpack_from("<II", data, len(data) - 9 - 8 * (count - i))
        out.append((at, packed, size))
        at += packed
    return out


def record_index(data: bytes) -> list[list]:
    """[page_id, frame, offset in the frame's content, length] of every record."""
    at, packed, _ = seek_table(data)[-1]
    return json.loads(zstandard.ZstdDecompressor().decompress(data[at + 8:at + packed]))


def records(data: bytes, wanted: set | None = None) -> Iterator[tuple[list, bytes]]:
    """(index entry, record bytes); with ``wanted`` ids only their frames are
    decompressed."""
    frames, plain, held = seek_table(data), zstandard.ZstdDecompressor(), (-1, b"")
    for entry in record_index(data):
        if wanted is None or entry[0] in wanted:
            if held[0] != entry[1]:
                at, packed, _ = frames[entry[1]]
                held = (entry[1], plain.decompress(data[at:at + packed]))
            yield entry, held[1][entry[2]:entry[2] + entry[3]]


def _bundle_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    bundle = Bundle()
    for rows in batches:
        for page_id, url, html, size, digest, refers in zip(*(rows[c] for c in (
                "page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to"))):
            page_id = None if pd.isna(page_id) else int(page_id)
            refers = None if pd.isna(refers) else int(refers)
            bundle.add(page_id, format_record(page_id, url, (html or "").encode(), size, digest, refers))
            if bundle.size >= BUNDLE_BYTES:
                yield pd.DataFrame({"data": [bundle.finish()[:-4]]})
                bundle = Bundle()
    if bundle.index:
        yield pd.DataFrame({"data": [bundle.finish()[:-4]]})


def plan_records(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with payload_bytes, payload_digest,
    refers_to. Of equal payloads of MIN_REVISIT_BYTES or more, rows with the
    largest page_id are responses and the others revisit it."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")) \
        .withColumn("payload_bytes", F.octet_length("html").cast("long")) \
        .withColumn("payload_digest", F.sha1(F.col("html").cast("binary")))
    # Only the ids of payloads that occur again are joined: one row a digest.
    last = rows.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).groupBy(F.col("payload_digest").alias("d")) \
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return rows.join(last, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") >= MIN_REVISIT_BYTES), "left") \
        .select("page_id", "url", "html", "payload_bytes", "payload_digest",
                F.when(F.col("page_id").eqNullSafe(F.col("last")), None).otherwise(F.col("last")).alias("refers_to"))


def write_bundles(pages: DataFrame, path: str) -> None:
    """Write ``pages`` as seekable WARC bundles, one bundle a file.

    The text sink writes the bytes of a string column as they are, one row a
    file here; its row terminator is the last four bytes of the seek table, so
    Spark's own committer puts whole bundles on any file system Spark knows.

    Null html is an empty payload, a null url is left out of the headers, a
    null page_id has the id ``urn:x-page:null``. Repeated rows are written
    each; those that share the largest page_id are all responses. Further
    columns are not written. An empty table gives an empty folder.
    """
    rows = plan_records(pages).mapInPandas(_bundle_rows, "data binary")
    rows.select(F.col("data").cast("string").alias("value")).write.option("maxRecordsPerFile", 1) \
        .option("encoding", "ISO-8859-1").option("lineSep", struct.pack("<I", SEEKABLE_MAGIC).decode("latin-1")) \
        .text(path)


def _read_rows(batches: Iterator[pd.DataFrame], wanted: set | None = None) -> Iterator[pd.DataFrame]:
    for files in batches:
        for path, data in zip(files["path"], files["content"]):
            out, held = [], 0
            for entry, raw in records(data, wanted):
                out.append(parse_record(raw) | {"bundle": path, "frame": entry[1], "frame_offset": entry[2]})
                held += len(raw)
                if held >= 8 * FRAME_BYTES:
                    yield _frame(out)
                    out, held = [], 0
            if out:
                yield _frame(out)


_RECORD = ("page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, "
           "refers_to long, bundle string, frame int, frame_offset long")


def _frame(rows: list[dict]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=[c.split()[0] for c in _RECORD.split(", ")])
    return df.astype({"page_id": "Int64", "refers_to": "Int64"})


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the bundles at ``path`` with its place."""
    return _files(spark, path).mapInPandas(_read_rows, _RECORD)


def fetch(spark: SparkSession, path: str, page_ids: list[int]) -> DataFrame:
    """The records named: only the frames that hold them are decompressed."""
    wanted = set(page_ids)

    def some(batches):
        return _read_rows(batches, wanted)
    return _files(spark, path).mapInPandas(some, _RECORD)


_SQL = f"""
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as digest from pages),
m as (select digest, max(page_id) as last from p where n >= {MIN_REVISIT_BYTES} group by digest)
select page_id, cast(n as bigint) as payload_bytes, p.digest as payload_digest,
       case when n >= {MIN_REVISIT_BYTES} and last <> page_id then 'revisit' else 'response' end as record_type,
       case when n >= {MIN_REVISIT_BYTES} and last <> page_id then last end as refers_to
from p left join m using (digest)
"""


@query("op4_warc_bundles", _SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_bundles(table(spark, sf_dir, "pages"), path)
    return read_bundles(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
