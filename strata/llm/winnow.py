"""Benchmark decontamination by winnowing (Schleimer, Wilkerson and Aiken 2003).

Of every WINDOW consecutive K-word hashes the smallest is a fingerprint, so two
texts sharing SPAN = WINDOW + K - 1 words share a fingerprint of that span.
Fingerprints that hit are extended to the SPAN-word windows around them, which
are then matched exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import query, stage, table

K, WINDOW = 5, 6
SPAN = K + WINDOW - 1
_SEED = 0x10
#: Bits of the fingerprint filter; fixed, whatever the benchmark's size.
FILTER_BITS = 1 << 23


def fingerprints(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the selected K-grams of all texts, in order.
    Texts of fewer than SPAN words have none."""
    g = W.grams(hashes, K, _SEED)
    n = len(g) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), g[:0]
    views = np.lib.stride_tricks.sliding_window_view(g, WINDOW)
    at = np.arange(n) + views.argmin(axis=1)
    ok = np.zeros(n, bool)  # windows that lie inside one text
    sizes = np.diff(first)
    for lo, size in zip(first[:-1][sizes >= SPAN], sizes[sizes >= SPAN]):
        ok[lo:lo + size - SPAN + 1] = True
    at = np.unique(at[ok])
    return at, g[at]


def window_hashes(w: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """(len(at), 2) 64-bit hashes of the ``size`` words from each position."""
    out = np.empty((len(at), 2), np.uint64)
    with np.errstate(over="ignore"):
        for lane in range(2):
            odd = W.odd_constants(size, _SEED + 7 + lane)
            acc = np.full(len(at), size, np.uint64)
            for j in range(size):
                acc += W.mix(w[at + j] ^ odd[j]) * odd[j]
            out[:, lane] = W.mix(acc)
    return out


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)) % np.uint64(FILTER_BITS)


_ITEM_WINDOWS = "item_id string, size int, h1 long, h2 long, marks array<long>"


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of every item. ``marks``: filter slots that make a document
    look for it (of the fingerprint; of the window itself if it is short)."""
    for rows, buf, offsets in W.slices(batches, "text"):
        w = W.Words(buf, offsets, W.ALNUM)
        ids = rows.column("item_id").to_pylist()
        out = []
        for i, n in enumerate(w.counts.tolist()):
            own = w.hash[w.first[i]:w.first[i] + n]
            if n >= SPAN:
                _, prints = fingerprints(own, np.array([0, n]))
                marks = _slots(prints).tolist()
                for h1, h2 in window_hashes(own, np.arange(n - SPAN + 1), SPAN).view(np.int64).tolist():
                    out.append((ids[i], SPAN, h1, h2, marks))
                    marks = []
            elif n:
                pair = window_hashes(own, np.zeros(1, np.int64), n)
                h1, h2 = pair.view(np.int64)[0].tolist()
                out.append((ids[i], n, h1, h2, _slots(pair[:, 0]).tolist()))
        cols = list(zip(*out)) if out else [[], [], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.list_(pa.int64()))],
            names=["item_id", "size", "h1", "h2", "marks"])


_CANDIDATES = "doc_id long, x long, n_words long, hits array<struct<at:int,size:int,h1:long,h2:long>>"


def _doc_rows(batches: Iterator[pa.RecordBatch], bits: bytes, short: list[int]) -> Iterator[pa.RecordBatch]:
    """Per document its word count and the windows that may be an item's."""
    marks = np.frombuffer(bits, np.uint8)

    def hit(h: np.ndarray) -> np.ndarray:
        s = _slots(h).astype(np.int64)
        return (marks[s >> 3] >> (s & 7)) & 1 > 0

    for rows, buf, offsets in W.slices(batches, "text"):
        w = W.Words(buf, offsets, W.ALNUM)
        counts, owner = w.counts, w.owner()
        at_all, size_all, h_all = [], [], []
        at, prints = fingerprints(w.hash, w.first)
        at = at[hit(prints)]
        if len(at):  # the windows that hold the fingerprint's words
            starts = np.unique((at[:, None] - np.arange(WINDOW)).reshape(-1))
            starts = starts[(starts >= 0) & (starts + SPAN <= len(owner))]
            starts = starts[owner[starts] == owner[starts + SPAN - 1]]
            at_all.append(starts)
            size_all.append(np.full(len(starts), SPAN))
            h_all.append(window_hashes(w.hash, starts, SPAN))
        for size in short:
            starts = np.arange(max(len(owner) - size + 1, 0))
            starts = starts[owner[starts] == owner[starts + size - 1]] if len(starts) else starts
            h = window_hashes(w.hash, starts, size)
            ok = hit(h[:, 0])
            at_all.append(starts[ok])
            size_all.append(np.full(int(ok.sum()), size))
            h_all.append(h[ok])
        if at_all:
            at, size, h = np.concatenate(at_all), np.concatenate(size_all), np.concatenate(h_all)
            order = np.argsort(at, kind="stable")
            at, size, h = at[order], size[order], h[order]
        else:
            at, size, h = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.uint64)
        lists = np.searchsorted(at, w.first).astype(np.int32)
        inside = at - w.first[owner[at]] if len(at) else at
        hits = pa.StructArray.from_arrays(
            [pa.array(inside.astype(np.int32)), pa.array(size.astype(np.int32)),
             pa.array(np.ascontiguousarray(h[:, 0]).view(np.int64)), pa.array(np.ascontiguousarray(h[:, 1]).view(np.int64))],
            names=["at", "size", "h1", "h2"])
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("x"), pa.array(counts.astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(lists), hits)], names=["doc_id", "x", "n_words", "hits"])


def _filter_bits(slots: DataFrame) -> bytes:
    blocks = slots.select((F.col("s") + 1).alias("s")).groupBy(F.bitmap_bucket_number("s").alias("i")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for r in blocks.toLocalIterator():  # FILTER_BITS / 8 bytes in all at most
        out[(r.i - 1) << 12:r.i << 12] = r.bits
    return bytes(out)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, x (hash of the
    text), n_words, n_hit, items (sorted ids, as strings), spans (word ranges).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A
    window is SPAN consecutive words of an item, or the whole item if it has
    fewer; a document word is hit if it lies in any occurrence of any window.

    The documents' fingerprints are first held against a bitmap of the
    benchmark's (of fixed size); only windows around those that hit are
    shuffled and joined with the benchmark's windows on 128-bit hashes.
    Winnowing guarantees that no occurrence of a full window goes unseen;
    shorter items are looked up at every position.

    Null or empty texts: no words, nothing hit. An item without words matches
    nothing; a null item_id counts as the id ''. Repeated rows of documents
    are all returned, repeated items count once. Further columns are ignored.
    """
    windows = stage(items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
                    .mapInArrow(_item_rows, _ITEM_WINDOWS), "windows")
    bits = _filter_bits(windows.select(F.explode("marks").alias("s")))
    short = sorted(r.size for r in windows.where(F.col("size") < SPAN).select("size").distinct().collect())
    found = stage(docs.select("doc_id", "text", F.xxhash64("text").alias("x"))
                  .mapInArrow(partial(_doc_rows, bits=bits, short=short), _CANDIDATES), "candidates")

    of_window = windows.groupBy("size", "h1", "h2").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    cand = found.where(F.size("hits") > 0).select("doc_id", "x", F.explode("hits").alias("h")) \
        .select("doc_id", "x", "h.at", "h.size", "h.h1", "h.h2").distinct()
    hits = cand.join(of_window, ["size", "h1", "h2"]).groupBy("doc_id", "x").agg(
        F.sort_array(F.collect_set(F.struct("at", "size"))).alias("occ"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"))
    spans = F.aggregate("occ", F.expr("cast(array() as array<struct<lo:int,hi:int>>)"), lambda acc, o: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1).hi >= o.at),
        F.concat(F.slice(acc, 1, F.size(acc) - 1),
                 F.array(F.struct(F.element_at(acc, -1).lo.alias("lo"),
                                  F.greatest(F.element_at(acc, -1).hi, o.at + o.size).alias("hi")))))
        .otherwise(F.concat(acc, F.array(F.struct(o.at.alias("lo"), (o.at + o.size).alias("hi"))))))
    hits = hits.select(F.col("doc_id").alias("d"), F.col("x").alias("hx"), "items", spans.alias("spans"))
    out = found.select("doc_id", "x", "n_words").join(
        hits, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("x") == F.col("hx")), "left")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s.hi - s.lo))
    return out.select("doc_id", "x", "n_words", F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
                      F.coalesce("spans", F.expr("cast(array() as array<struct<lo:int,hi:int>>)")).alias("spans"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, unchanged."""
    bad = contamination(docs, items).where("n_hit > 0").select(F.col("doc_id").alias("_d"), F.col("x").alias("_x")).distinct()
    return docs.join(bad, docs.doc_id.eqNullSafe(bad._d) & (F.xxhash64(docs.text) == bad._x), "left_anti")


_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
win as (select distinct item_id, size, array_to_string(ws[i:i + size - 1], ' ') as x
  from (select item_id, ws, least(len(ws), 10) as size, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) as i from b where len(ws) > 0)),
sizes as (select distinct size from win),
pos as (select doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') as x
  from (select doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) as i from d, sizes where len(ws) >= size)),
hits as (select p.doc_id, p.i, p.size, w.item_id from pos p join win w on w.size = p.size and w.x = p.x),
n as (select doc_id, count(distinct spot) as n_hit from (select doc_id, unnest(range(i, i + size)) as spot from hits) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from hits) group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join its using (doc_id)
"""


@query("op10_winnowing_decontamination", _SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))
