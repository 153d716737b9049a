"""Near-duplicate documents by fast similarity sketching (Dahlgaard, Knudsen
and Thorup 2017), banding and exact verification.

Sketch: a set is thrown into ``t`` bins in rounds. In round i < t every shingle
goes to a hashed bin with value (i, hash); in round t + j every shingle goes to
bin j. A bin keeps its smallest value, and the rounds end once every bin holds
one, so each coordinate is filled for any set and agreement of two sketches is
concentrated around their Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import query, stage, table
from strata.llm.components import connected_components

#: 25 bands of 5 rows: a pair at similarity 0.85 shares no band with
#: probability (1 - 0.85^5)^25 = 4e-7, one at 0.8 with 5e-5.
BANDS, ROWS = 25, 5
_SEED = 0x5EED


def shingle_sets(w: W.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, first index per text). A
    text of fewer than k words, but not none, has its whole sequence as one."""
    n_words = w.counts
    whole = W.grams(w.hash, k, _SEED)
    parts: list[np.ndarray] = []
    for i, n in enumerate(n_words):
        at = w.first[i]
        if n >= k:
            g = np.sort(whole[at:at + n - k + 1])
            keep = np.empty(len(g), bool)
            keep[0] = True
            np.not_equal(g[1:], g[:-1], out=keep[1:])
            parts.append(g[keep])
        elif n:
            parts.append(W.grams(w.hash[at:at + n], int(n), _SEED + int(n)))
        else:
            parts.append(whole[:0])
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else whole[:0]), first


def sketch(shingles: np.ndarray, first: np.ndarray, t: int) -> np.ndarray:
    """(texts, t) sketch values; rows of empty sets stay at the maximum."""
    n = len(first) - 1
    top = np.uint64(2**64 - 1)
    out = np.full(n * t, top, np.uint64)
    sizes = np.diff(first)
    owner = np.repeat(np.arange(n), sizes)
    open_ = sizes > 0
    live, who = shingles, owner
    odd = W.odd_constants(2 * t, _SEED + 1)
    for i in range(2 * t):
        if not len(live):
            break
        with np.errstate(over="ignore"):
            h = W.mix((live ^ odd[i]) * odd[i])
        if i < t:
            at = who * t + ((h >> np.uint64(40)) % np.uint64(t)).astype(np.int64)
        else:
            at = who * t + (i - t)
        # The round comes first in the order, the hash second.
        value = (np.uint64(i) << np.uint64(52)) | (h & np.uint64((1 << 52) - 1))
        np.minimum.at(out, at, value)
        done = (out.reshape(n, t) != top).all(axis=1)
        if (done & open_).any():
            open_ &= ~done
            stay = open_[who]
            live, who = live[stay], who[stay]
    return out.reshape(n, t)


def signatures(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16 bytes per set, the same for equal sets (order-free sums)."""
    with np.errstate(over="ignore"):
        a = W.mix(W.run_sum(W.mix(shingles ^ np.uint64(0xA5)), first) ^ np.diff(first).astype(np.uint64))
        b = W.run_sum(W.mix(shingles * np.uint64(0x9FB21C651E98DF25)), first)
    return np.stack([a, b], axis=1)


def band_keys(sk: np.ndarray) -> np.ndarray:
    keys = np.empty((len(sk), BANDS), np.uint64)
    odd = W.odd_constants(ROWS + BANDS, _SEED + 2)
    with np.errstate(over="ignore"):
        for b in range(BANDS):
            acc = np.full(len(sk), odd[ROWS + b], np.uint64)
            for r in range(ROWS):
                acc += W.mix(sk[:, b * ROWS + r] ^ odd[r]) * odd[r]
            keys[:, b] = W.mix(acc)
    return keys


def _binary16(pairs: np.ndarray) -> pa.Array:
    data = pa.py_buffer(np.ascontiguousarray(pairs).tobytes())
    offs = pa.py_buffer(np.arange(len(pairs) + 1, dtype=np.int32) * 16)
    return pa.Array.from_buffers(pa.binary(), len(pairs), [None, offs, data])


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))


_SKETCHED = "doc_id long, x long, n_shingles long, sig binary, bands array<long>"


def _sketch_rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for rows, buf, offsets in W.slices(batches, "text"):
        sets, first = shingle_sets(W.Words(buf, offsets, W.SPACED), k)
        keys = band_keys(sketch(sets, first, BANDS * ROWS))
        sizes = np.diff(first)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("x"), pa.array(sizes), _binary16(signatures(sets, first)),
             pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * BANDS),
                                      pa.array(keys.reshape(-1).view(np.int64)))],
            names=["doc_id", "x", "n_shingles", "sig", "bands"])


def _set_rows(batches: Iterator[pa.RecordBatch], k: int, bits: bytes) -> Iterator[pa.RecordBatch]:
    marks = np.frombuffer(bits, np.uint8)
    for batch in batches:
        at = np.asarray(batch.column("slot")) - 1
        batch = batch.filter(pa.array((marks[at >> 3] >> (at & 7)) & 1 > 0))
        for _, buf, offsets in W.slices([batch], "text"):
            sets, first = shingle_sets(W.Words(buf, offsets, W.SPACED), k)
            yield pa.RecordBatch.from_arrays([_binary16(signatures(sets, first)), _lists(sets, first)],
                                             names=["sig", "shingles"])


#: Bits of the id filter; its size is fixed, whatever the number of candidates.
FILTER_BITS = 1 << 23


def _slot(col: str):
    return F.pmod(F.xxhash64(col), F.lit(FILTER_BITS)) + 1


def _filter_bits(ids: DataFrame, col: str) -> bytes:
    """A bitmap of fixed size over hashed ids. Ids it lets through wrongly
    only cost time; none is left out."""
    blocks = ids.select(_slot(col).alias("s")).groupBy(F.bitmap_bucket_number("s").alias("i")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for r in blocks.toLocalIterator():  # FILTER_BITS / 8 bytes in all at most
        out[(r.i - 1) << 12:r.i << 12] = r.bits
    return bytes(out)


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets have den * |A and B| >= num * |A or B|."""
    sa = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(sa, "a").join(sb, "b") \
        .where(den * both >= num * (F.size("sa") + F.size("sb") - both)).select("a", "b")


#: Counters by which prefixes are ordered; their number is fixed.
COUNTERS = 1 << 19


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets of this task have a shingle in each slot."""
    seen = np.zeros(COUNTERS, np.int64)
    for b in batches:
        lists = b.column("shingles")
        at = np.asarray(lists.flatten()).view(np.uint64) % np.uint64(COUNTERS)
        seen += np.bincount(at.astype(np.int64), minlength=COUNTERS)
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["slot", "n"])


def _prefix_rows(batches: Iterator[pa.RecordBatch], counts: bytes, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Per set its first shingles, rarest slot first, as far as they can decide
    whether another set is similar; those that no other set has are left out."""
    rare = np.frombuffer(counts, np.uint32)
    for b in batches:
        lists = b.column("shingles")
        sizes = np.asarray(pa.compute.list_value_length(lists)).astype(np.int64)
        values = np.asarray(lists.flatten())
        owner = np.repeat(np.arange(len(sizes)), sizes)
        n = rare[(values.view(np.uint64) % np.uint64(COUNTERS)).astype(np.int64)]
        order = np.lexsort((values, n, owner))
        first = np.concatenate([[0], np.cumsum(sizes)])
        pos = np.arange(len(values)) - np.repeat(first[:-1], sizes)
        keep = (pos < np.repeat(sizes - (sizes * num + den - 1) // den + 1, sizes)) & (n[order] > 1)
        kept = np.bincount(owner[keep], minlength=len(sizes))
        offsets = pa.array(np.concatenate([[0], np.cumsum(kept)]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [b.column("sig"), pa.array(sizes), pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
                [pa.array(pos[keep]), pa.array(values[order][keep])], names=["pos", "g"]))], names=["sig", "n", "prefix"])


def _prefix_pairs(sets: DataFrame, comps: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of ``sets`` (sig, shingles) of different components
    (``comps``: sig, comp) that can be similar enough: every such pair is there.

    With shingles in any one order, sets A and B that are similar enough share
    one within the first |A| - ceil(num / den * |A|) + 1 of A and the same of B;
    and the first one they share leaves room for the overlap asked for. They are
    ordered by counters of a fixed number, rarest first, so what only one group
    has comes first and groups that overlap too little seldom meet. A counter
    is never below a shingle's number of sets: what it shows once is shared by
    none. Sets stay where they are; only prefixes are shuffled."""
    seen = sets.mapInArrow(_slot_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.uint32)
    counts[np.asarray(seen["slot"])] = np.minimum(np.asarray(seen["n"]), 2**32 - 1)
    cut = sets.mapInArrow(partial(_prefix_rows, counts=counts.tobytes(), num=num, den=den),
                          "sig binary, n long, prefix array<struct<pos:long,g:long>>")
    prefix = stage(cut.join(comps, "sig").select("sig", "n", "comp", F.explode("prefix").alias("p"))
                   .select("sig", "n", "comp", "p.pos", "p.g"), "prefixes")
    other = prefix.select("g", *[F.col(c).alias("b" + c) for c in ("sig", "n", "comp", "pos")])
    room = F.least(F.col("n") - F.col("pos"), F.col("bn") - F.col("bpos"))
    return prefix.join(other, "g").where(
        (F.col("sig") < F.col("bsig")) & (F.col("comp") != F.col("bcomp"))
        & (den * F.least("n", "bn") >= num * F.greatest("n", "bn"))
        & (room * (num + den) >= num * (F.col("n") + F.col("bn")))) \
        .select(F.col("sig").alias("a"), F.col("bsig").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, x (hash of the
    text), n_shingles, sig (16-byte set signature), comp (smallest sig of the
    component, null without shingles), component_id, kept.

    Documents are linked when ``den * |A and B| >= num * |A or B|`` over their
    distinct k-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased);
    component_id is the smallest doc_id reachable by links. Only ``comp`` tells
    components apart whose smallest doc_ids are equal or null.

    - Equal sets form one class first (grouped on the set's signature with
      map-side combine), so thousands of copies cost one sketch row.
    - Classes sharing a band are linked to that bucket's most central class
      and verified on full sets; then all classes of a bucket that still holds
      several components are joined exactly (prefix filter), so no link
      between components is left untested. There is no cap on a bucket.
    - Full sets are made again from the texts of candidate classes only.

    Null or empty text, or text without words: no shingles, linked with
    nothing. Null doc_id: takes part, never names a component unless the whole
    component has none. Repeated rows: one class; each row is returned.
    Further columns are ignored.
    """
    spark = docs.sparkSession
    narrow = docs.select("doc_id", "text")
    sk = stage(narrow.withColumn("x", F.xxhash64("text")).mapInArrow(partial(_sketch_rows, k=k), _SKETCHED), "sketch")

    classes = stage(sk.where("n_shingles > 0").groupBy("sig").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    member = classes.select("sig", "n", F.explode("bands").alias("key"))
    # Tables joined on a bucket's key are written first: the joins then deal
    # out both sides themselves, and a hot bucket can be split.
    shared = stage(member.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "shared")
    member = stage(member.join(shared, "key"), "buckets")

    central = member.groupBy("sig").agg(F.sum("m").alias("central"))
    leaders = stage(member.join(central, "sig").groupBy("key")
                    .agg(F.max(F.struct("central", "sig", "n")).alias("top")), "leaders")
    near_size = den * F.least("n", "bn") >= num * F.greatest("n", "bn")
    star = member.join(leaders.select("key", F.col("top.sig").alias("b"), F.col("top.n").alias("bn")), "key") \
        .where((F.col("sig") != F.col("b")) & near_size) \
        .select(F.least("sig", "b").alias("a"), F.greatest("sig", "b").alias("b")).distinct()
    star = stage(star, "star")

    def set_table(nodes: DataFrame) -> DataFrame:
        bits = _filter_bits(nodes.join(classes, "sig").select("rep"), "rep")
        made = narrow.select("text", _slot("doc_id").alias("slot")).mapInArrow(
            partial(_set_rows, k=k, bits=bits), "sig binary, shingles array<long>")
        return stage(made.join(nodes, "sig", "left_semi").groupBy("sig").agg(F.first("shingles").alias("shingles")), "sets")

    ends = star.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    linked = stage(_verify(star, set_table(ends), num, den), "links")
    comp = connected_components(linked)

    # What a star may miss: pairs of classes that meet in a bucket and are in
    # different components. Those classes are joined exactly on set prefixes.
    named = member.join(comp, member.sig == comp.node, "left") \
        .select("key", "sig", "n", F.coalesce("comp", "sig").alias("comp"))
    split = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    split = stage(split, "split-keys")
    left = stage(named.join(split, "key").select("sig", "n", "comp").distinct(), "split")
    sets = set_table(left.select("sig"))
    rest = stage(_prefix_pairs(sets, left.select("sig", "comp").distinct(), num, den).join(star, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = stage(_verify(rest, sets, num, den), "more")
        if not more.isEmpty():
            comp = connected_components(linked.unionByName(more))

    of_class = classes.select("sig", "rep").join(comp, classes.sig == comp.node, "left") \
        .select("sig", "rep", F.coalesce("comp", "sig").alias("comp"))
    lowest = of_class.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of_class = of_class.join(lowest, "comp").select("sig", "comp", "component_id")
    worded = sk.where("n_shingles > 0").drop("bands").join(of_class, "sig") \
        .select("doc_id", "x", "n_shingles", "sig", "comp", "component_id")
    bare = sk.where("n_shingles = 0").select("doc_id", "x", "n_shingles", "sig", F.lit(None).cast("binary").alias("comp"),
                                               F.col("doc_id").alias("component_id"))
    return worded.unionByName(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each near-duplicate group (the smallest doc_id,
    then the smallest text hash) and every row without words. All columns stay;
    a repeated row counts as a copy. Unlike texts under one id, or without
    any, are groups of their own."""
    got = near_duplicates(docs, k, num, den)
    one = got.where("kept and n_shingles > 0").groupBy("comp", F.col("doc_id").alias("_d")) \
        .agg(F.min("x").alias("_x")).select("_d", "_x").distinct()
    # The given columns travel as one struct: no name of theirs can clash.
    keyed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_x"))
    first = keyed.join(one, keyed["_d"].eqNullSafe(one["_d"]) & (keyed["_x"] == one["_x"]), "left_semi") \
        .dropDuplicates(["_d", "_x"]).select("_row.*")
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return first.unionByName(docs.where(wordless))


_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as ws from documents),
sets as (select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, chr(32))]
  else [ws[i] || chr(32) || ws[i + 1] || chr(32) || ws[i + 2] for i in range(1, len(ws) - 1)] end) as s from w),
g as (select doc_id, len(s) as n, unnest(s) as x from sets),
links as (select a.doc_id as a, b.doc_id as b from g a join g b on a.x = b.x and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ as (select a, b from links union all select b, a from links),
reach(doc_id, c) as (select doc_id, doc_id from documents union select r.doc_id, e.b from reach r join both_ e on e.a = r.c)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(c) as component_id, min(c) = s.doc_id as kept
from sets s join reach r on r.doc_id = s.doc_id group by s.doc_id, s.s
"""


@query("op5_minhash_near_dedup", _SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85, den=100) \
        .select("doc_id", "n_shingles", "component_id", "kept")
