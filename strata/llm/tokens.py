"""Token ids in ORC: integer run-length encoded stripes with row indexes and
Bloom filters on the document id.

Files hold documents in ascending doc_id order, one range of ids a file, so a
reader can take stripes in parallel, and a lookup by id reads the stripes that
min/max indexes and Bloom filters leave.
"""

from __future__ import annotations

import ctypes
import gc
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import fresh_path, query, table

END_ID = 1
#: ORC layout: a stripe is the unit of a parallel read, an index entry covers
#: ROW_STRIDE documents.
STRIPE_BYTES, ROW_STRIDE, BLOOM_FPP = 64 << 20, 1000, 0.01
#: Text bytes a file should hold.
FILE_BYTES = 64 << 20
#: Words whose ids a worker remembers. Half of them are the words met last; when
#: they are that many, the other half, met before and not since, is forgotten.
CACHE_WORDS = 600_000
_SLICE = 2 << 20
#: Words given to the tokenizer as one text.
_JOINED = 4000


@lru_cache(maxsize=4)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


#: An ASCII letter, a run of ASCII punctuation that ends a word. The tokenizer
#: never joins a letter and such a mark, so a space between them changes no id;
#: apostrophes (contractions) and what special tokens end in are left alone.
_WORD_END = r"([A-Za-z])([!-&(-/:-=?-@\[-`{-~]+)(\s|$)"


# The normaliser and the pre-tokenizer of which the rules used here
# are known: no pre-token holds white space, and case does not tell words apart.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PRE_TOKENIZER = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]


class _Memory:
    """The ids of words; a word's code is its place. Code 0 is END_ID alone."""

    def __init__(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 16, np.int64)
        self.flat[0], self.ends[0] = END_ID, 1
        self.n, self.used = 1, 1

    def keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(words) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.ends[self.n:self.n + len(words)] = self.used + np.cumsum(sizes)
        self.codes.update(zip(words, range(self.n, self.n + len(words))))
        self.n += len(words)
        self.used += len(ids)

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per code) of the words in order."""
        begins = self.ends[codes - 1]
        begins[codes == 0] = 0
        size = self.ends[codes] - begins
        before = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(int(before[-1]), dtype=np.int32) + np.repeat((begins - before[:-1]).astype(np.int32), size)
        return self.flat[at], size


class _Encoder:
    """Encodes texts, word by word where the tokenizer allows it.

    If its pattern never joins characters across white space, a text's ids are
    those of its space-separated words in order; each word goes through the
    tokenizer when a worker meets it first, or after it was forgotten. Words of
    ASCII characters that differ in case alone have the same ids. Of other
    tokenizers nothing is taken for granted: they get whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.by_word = all((spec.get(k) or {}).get("type") == "Sequence" for k in ("normalizer", "pre_tokenizer")) \
            and spec["normalizer"]["normalizers"] == _NORMALIZER and spec["pre_tokenizer"]["pretokenizers"] == _PRE_TOKENIZER
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") if model.get("type") == "BPE" else None
        self.is_end = None
        if suffix:
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self.is_end = np.zeros(max(vocab.values()) + 1, bool)
            self.is_end[[i for w, i in vocab.items() if w.endswith(suffix)]] = True
        self.new, self.old = _Memory(), _Memory()

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w.isalpha()]
        if self.is_end is not None:
            # A word of ASCII letters is one pre-token and has one last token,
            # which the ids alone show; if the counts differ, one got none.
            ascii_words = [w for w in plain if w.isascii()]
            for lo in range(0, len(ascii_words), _JOINED):
                part = ascii_words[lo:lo + _JOINED]
                ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int32)
                ends = np.flatnonzero(self.is_end[ids])
                if len(ends) == len(part):
                    self.new.keep(part, ids, np.diff(ends, prepend=-1))
            plain = [w for w in plain if w not in self.new.codes]
        for lo in range(0, len(plain), _JOINED):
            part = plain[lo:lo + _JOINED]
            # One text of letter words is one pre-token a word, unless a
            # character changes its kind when it is normalised.
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            sizes = np.bincount(np.array(e.word_ids, np.int64), minlength=len(part)) if e.ids else np.zeros(0, np.int64)
            if len(sizes) == len(part) and sizes.all():
                self.new.keep(part, np.array(e.ids, np.int32), sizes)
        rest = [w for w in words if w not in self.new.codes]
        if rest:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            self.new.keep(rest, np.fromiter((i for x in got for i in x), np.int32), np.array([len(x) for x in got]))

    def _codes(self, words: list[str]) -> list[int]:
        if len(self.new.codes) > CACHE_WORDS // 2:
            self.old, self.new = self.new, _Memory()
        code = list(map(self.new.codes.get, words))
        if None not in code:
            return code
        missing = list(dict.fromkeys(w for w, c in zip(words, code) if c is None))
        known = [(w, c) for w, c in zip(missing, map(self.old.codes.get, missing)) if c is not None]
        if known:
            self.new.keep([w for w, _ in known], *self.old.take(np.array([c for _, c in known], np.int64)))
            missing = [w for w in missing if w not in self.new.codes]
        self._learn(missing)
        return list(map(self.new.codes.get, words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids per text), each text ended by END_ID."""
        if not self.by_word:
            got = [[*e.ids, END_ID] for e in self.tokenizer.encode_batch_fast(texts.fill_null("").to_pylist(), add_special_tokens=False)]
            return np.fromiter((i for x in got for i in x), np.int32), np.array([len(x) for x in got], np.int64)
        spread = pc.replace_substring_regex(texts.fill_null(""), _WORD_END, r"\1 \2\3")
        lists = pc.ascii_split_whitespace(spread)
        coded = pc.dictionary_encode(lists.flatten())
        words = coded.dictionary
        # Special tokens' strings are told apart by case.
        fold = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<")))
        code = self._codes(pc.if_else(fold, pc.ascii_lower(words), words).to_pylist())
        # Code 0 is the end id, which stands after every text's words.
        first = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
        n_words = np.diff(first)
        at = np.zeros(int(first[-1]) + len(n_words), np.int64)
        inner = np.ones(len(at), bool)
        inner[first[1:] + np.arange(len(n_words))] = False
        at[inner] = np.array(code, np.int64)[np.asarray(coded.indices)] if code else 0
        ids, size = self.new.take(at)
        before = np.concatenate([[0], np.cumsum(size)])
        return ids, np.diff(before[np.concatenate([[0], np.cumsum(n_words + 1)])])


def _give_back() -> None:
    """Return what the allocator holds to the system: a worker waits for its
    next task beside an executor that needs the memory."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def _encode_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    enc = _encoder(path)
    for batch in batches:
        text = batch.column("text").cast(pa.large_string()).fill_null("")
        ends = np.cumsum(np.asarray(pc.binary_length(text)))
        lo = 0
        while lo < batch.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + _SLICE, "right")))
            ids, n_ids = enc.encode(text.slice(lo, hi - lo))
            first = np.concatenate([[0], np.cumsum(n_ids)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(n_ids),
                 pa.ListArray.from_arrays(pa.array(first), pa.array(ids))], names=["doc_id", "n_tokens", "ids"])
            lo = hi
        pa.default_memory_pool().release_unused()
    _give_back()


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str) -> None:
    """Write the token ids of ``docs`` (doc_id, text) as ORC at ``path``:
    columns doc_id, n_tokens, ids (END_ID appended to each document).

    Texts are range-partitioned and sorted by doc_id before they are encoded,
    so ids are never shuffled. Rows of one doc_id stay together, ordered by
    text. Null doc_ids come first, null and empty texts hold the end id alone,
    repeated rows are all written, further columns are not. An empty table
    gives a readable ORC folder without rows.
    """
    n_bytes = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(-(-n_bytes // FILE_BYTES)), docs.sparkSession.sparkContext.defaultParallelism)
    placed = docs.select("doc_id", "text").repartitionByRange(files, "doc_id", F.xxhash64("text")) \
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    placed.mapInArrow(partial(_encode_rows, path=tokenizer_path), "doc_id long, n_tokens long, ids array<int>") \
        .write.option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES) \
        .option("orc.row.index.stride", ROW_STRIDE).option("orc.create.index", "true") \
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", BLOOM_FPP).orc(path)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column("ids")
        offs = np.asarray(lists.offsets)
        raw = memoryview(np.ascontiguousarray(np.asarray(lists.values), "<i4")).cast("B")
        crc = [zlib.crc32(raw[4 * lo:4 * hi]) for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [b.column("file"), b.column("block"), b.column("row"), b.column("doc_id"), pa.array(np.diff(offs).astype(np.int64)),
             pa.array(crc, pa.int64())], names=["file", "block", "row", "doc_id", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens, ids of a token folder, stripe-parallel."""
    return spark.read.schema("doc_id long, n_tokens long, ids array<int>").orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The documents named; indexes and Bloom filters spare the other stripes."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(doc_ids))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a token folder: doc_id, start (ids of all documents
    before it, in file order), n_tokens, ids_crc32 (of its ids as stored)."""
    read = read_tokens(spark, path).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "doc_id", "ids")
    rows = read.mapInArrow(_digest_rows, "file long, block long, row long, doc_id long, n_tokens long, ids_crc32 long")
    # Offsets of whole files come from the small columns alone: one row a file.
    sizes = spark.read.schema("n_tokens long").orc(path).groupBy(
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long").alias("file")) \
        .agg(F.sum("n_tokens").alias("n"))
    before = sizes.select(F.col("file").alias("f"), (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("doc_id", "block", "row")
                                    .rowsBetween(Window.unboundedPreceding, -1))
    return rows.select("*", F.coalesce(inside, F.lit(0)).alias("inside")).join(before, F.col("file") == F.col("f")) \
        .select("doc_id", (F.col("base") + F.col("inside")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write ``docs`` to a fresh token folder and return its index."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path)
    return token_index(docs.sparkSession, path)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op2_token_ids_orc")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"), default_tokenizer())
