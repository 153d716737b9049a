"""Near-duplicate vectors by product quantisation: coarse inverted lists,
residual subspace codes, asymmetric table lookups and an exact cosine rerank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import query, stage, table
from strata.llm.components import connected_components

#: Vectors the index is fitted on, at most (those with the smallest hashes of
#: their ids); every vector is indexed.
SAMPLE = 16_384
#: Rows of a list per list wanted, and the most lists (it bounds the centroid
#: table that each task holds: MAX_LISTS x dimensions).
LIST_ROWS, MAX_LISTS = 400, 4096
SUBSPACES, CODES = 8, 64
#: Rows of a list compared at once: a longer list is cut into such blocks.
BLOCK = 2048
#: Spread of a near vector's offset along one direction that a probe covers,
#: in standard deviations.
PROBE_SIGMAS = 4.0
#: Deviations of the sample's error within which most approximate similarities
#: lie (a measure of the codes; the sieve has a bound of its own per entry).
ADC_SIGMAS = 6.0
#: What rounding may take from a sum of products of unit vectors, amply.
ROUNDING = 1e-6


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(x)))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        n = np.bincount(at, minlength=k)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], x[rng.choice(len(x), k)])
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = (c * c).sum(axis=1) / 2
    for lo in range(0, len(x), 4096):
        out[lo:lo + 4096] = (x[lo:lo + 4096] @ c.T - half).argmax(axis=1)
    return out


class Index:
    """Coarse centroids and residual codebooks for unit vectors."""

    def __init__(self, sample: np.ndarray, n_lists: int, min_cos: float):
        self.dim = sample.shape[1]
        self.min_cos = min_cos
        self.lists = kmeans(sample, n_lists)
        self.cuts = np.linspace(0, self.dim, SUBSPACES + 1).astype(int)
        at = nearest(sample, self.lists)
        residual = sample - self.lists[at]
        self.books = [kmeans(residual[:, a:b], CODES) for a, b in zip(self.cuts[:-1], self.cuts[1:])]
        # Error of the asymmetric estimate of a cosine, from the sample.
        lost = residual - self.decode(self.encode(residual))
        self.error = float(np.sqrt((lost ** 2).sum(axis=1).mean() / self.dim)) if self.dim else 0.0

    def encode(self, residual: np.ndarray) -> np.ndarray:
        return np.stack([nearest(residual[:, a:b], book) for a, b, book in
                         zip(self.cuts[:-1], self.cuts[1:], self.books)], axis=1).astype(np.uint8)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([book[codes[:, j]] for j, book in enumerate(self.books)], axis=1)

    def floors(self, x: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Per vector of x, decoded as ``back``: the least approximate cosine
        q.back that a unit vector q linked to it can have. With l = x - back,
        q.back = q.x - x.l - (q - x).l, and |q - x| <= sqrt(2 - 2 min_cos)."""
        lost = x - back
        r = math.sqrt(max(2 - 2 * self.min_cos, 0.0))
        return self.min_cos - (x * lost).sum(axis=1) - r * np.sqrt((lost * lost).sum(axis=1)) - ROUNDING

    def probes(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for every list that may hold a vector near to x.

        y near x lies |x - y| <= r away; it is in list c only if it has crossed
        the plane between c and x's own centroid. x's distance to that plane is
        held against the spread of y - x along the plane's normal."""
        r = math.sqrt(2 - 2 * self.min_cos)
        reach = min(r, PROBE_SIGMAS * r / math.sqrt(max(self.dim, 1)))
        half = (self.lists ** 2).sum(axis=1) / 2
        gap = np.sqrt(np.maximum(2 * (half[:, None] + half[None, :] - self.lists @ self.lists.T), 1e-12))
        rows, lists = [], []
        for lo in range(0, len(x), 1024):
            part, mine = x[lo:lo + 1024], own[lo:lo + 1024]
            near = part @ self.lists.T - half
            behind = near[np.arange(len(part)), mine][:, None] - near
            i, c = np.nonzero(behind <= reach * gap[mine])
            rows.append(i + lo)
            lists.append(c)
        return np.concatenate(rows), np.concatenate(lists)


def _unit(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision (all rows hold one length)."""
    lists = column.flatten()
    flat = np.asarray(lists, float)
    n = len(column)
    x = flat.reshape(n, -1) if n else np.zeros((0, 0))
    if n:  # neither huge nor tiny components overflow or vanish when squared
        x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _assign_rows(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            x = _unit(b.column("v"))
            own = nearest(x, index.lists)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("copies"), b.column("v"), pa.array(own.astype(np.int32))],
                                             names=["id", "copies", "v", "list"])


def _probe_rows(batches: Iterator[pa.RecordBatch], index: Index, blocks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per vector and list to look into: as entry (side 0) of its own
    list, as query (side 1) of every list probed, cut into blocks. Both sides
    of a pair of blocks (bl, bq) of a list meet in one group."""
    for b in batches:
        if not b.num_rows:
            continue
        x = _unit(b.column("v"))
        own = np.asarray(b.column("list")).astype(np.int64)
        salt = np.asarray(b.column("salt"))
        rows, lists = index.probes(x, own)
        at, side, li, bl, bq = [], [], [], [], []
        for s, r, c in ((0, np.arange(len(x)), own), (1, rows, lists)):
            n = blocks[c]
            rep = np.repeat(np.arange(len(r)), n)
            step = np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n)
            mine = salt[r][rep] % n[rep]
            at.append(r[rep])
            side.append(np.full(len(rep), s, np.int8))
            li.append(c[rep])
            bl.append(mine if s == 0 else step)
            bq.append(step if s == 0 else mine)
        at = np.concatenate(at)
        for lo in range(0, len(at), 20_000):
            cut = slice(lo, lo + 20_000)
            take = pa.array(at[cut])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v)[cut].astype(np.int32)) for v in (li, bl, bq)]
                + [pa.array(np.concatenate(side)[cut].astype(np.int32))]
                + [b.column(c).take(take) for c in ("id", "copies", "v", "list")],
                names=["li", "bl", "bq", "side", "id", "copies", "v", "list"])


def _compare(t: pa.Table, index: Index) -> pa.Table:
    """Links of one block of queries with one block of entries: per vector the
    number linked directly, and the smallest id of its set in the spanning
    forest of the block's links (which keeps them connected). A query counts
    what it finds; the entry is told as well unless it probes the query's own
    list, where it finds the pair itself."""
    side = np.asarray(t.column("side").combine_chunks())
    ids = np.asarray(t.column("id").combine_chunks())
    copies = np.asarray(t.column("copies").combine_chunks())
    own = np.asarray(t.column("list").combine_chunks()).astype(np.int64)
    x = _unit(t.column("v").combine_chunks())
    e, q = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    names, local = np.unique(ids, return_inverse=True)
    count = np.zeros(len(names), np.int64)
    root = np.arange(len(names))  # spanning forest of the block's links
    if len(e) and len(q):
        li = int(t.column("li")[0].as_py())
        entries = x[e]
        codes = index.encode(entries - index.lists[li]).astype(np.int64)
        floor = index.floors(entries, index.lists[li] + index.decode(codes))
        # Do the entries probe the queries' own lists? Then they find the pair too.
        probed = np.zeros((len(e), len(index.lists)), bool)
        rows, lists = index.probes(entries, np.full(len(e), li))
        probed[rows, lists] = True
        for lo in range(0, len(q), 256):
            part = q[lo:lo + 256]
            approx = np.repeat((x[part] @ index.lists[li])[:, None], len(e), axis=1)
            for j, (a, b) in enumerate(zip(index.cuts[:-1], index.cuts[1:])):
                approx += (x[part, a:b] @ index.books[j].T)[:, codes[:, j]]
            i, k = np.nonzero(approx >= floor)
            near = ids[part][i] != ids[e][k]
            i, k = i[near], k[near]
            exact = np.einsum("ij,ij->i", x[part][i], entries[k]) if len(i) < 200_000 else \
                (x[part] @ entries.T)[i, k]
            link = exact >= index.min_cos
            i, k = i[link], k[link]
            np.add.at(count, local[part][i], copies[e][k])
            back = ~probed[k, own[part][i]]
            np.add.at(count, local[e][k[back]], copies[part][i[back]])
            _join(root, local[part][i], local[e][k])
    some = np.flatnonzero((count > 0) | (root != np.arange(len(names))))
    return pa.table({"id": pa.array(names[some]), "n": pa.array(count[some]), "root": pa.array(names[root[some]])})


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i] in ``root`` (a forest of depth one)."""
    while True:
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        if (ra == rb).all():
            return
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while (root[root] != root).any():
            root[:] = root[root]


def _block_links(classes: DataFrame, n_rows: int, min_cos: float) -> DataFrame:
    """(id, n, root) of every block of ``classes`` (v, id, copies; vectors of
    one length): see ``_compare``."""
    kind = classes.schema["v"].dataType.simpleString()
    sample = classes.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow().column("v")
    index = Index(_unit(sample.combine_chunks()), min(MAX_LISTS, max(1, math.ceil(n_rows / LIST_ROWS))), min_cos)

    assigned = stage(classes.mapInArrow(partial(_assign_rows, index=index), f"id long, copies long, v {kind}, list int"),
                     "vec-assigned")
    blocks = np.ones(len(index.lists), np.int64)
    for r in assigned.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():  # MAX_LISTS rows at most
        blocks[r.list] = -(-r.n // BLOCK)
    met = assigned.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(1 << 30))).mapInArrow(
        partial(_probe_rows, index=index, blocks=blocks),
        f"li int, bl int, bq int, side int, id long, copies long, v {kind}, list int")

    def compare(t):
        return _compare(t, index)
    return stage(met.groupBy("li", "bl", "bq").applyInArrow(compare, "id long, n long, root long"), "vec-links")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cos: float = 0.95) -> DataFrame:
    """One row per row of ``rows``: the id, n_links (other vectors linked
    directly), component_id (smallest id reachable), kept.

    Vectors are linked when their cosine, in double precision, is at least
    ``min_cos``. Exactly equal vectors are one class from the start. An index
    is fitted on SAMPLE vectors and holds all of its length; a vector looks into every list
    whose border is near enough to it (PROBE_SIGMAS), so probes follow the
    data; codes sift by a bound that loses no link, exact cosines decide. A list of any size is compared in
    blocks of BLOCK x BLOCK, and only counts and a spanning forest leave a block.

    Vectors of unlike lengths are never linked; each length has an index of its
    own. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing. A null id takes part in no link. Repeated rows count as vectors;
    different vectors under one id are one node of the links.
    """
    given = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    sound = F.col("v").isNotNull() & F.col("id").isNotNull() & (F.size("v") > 0) \
        & F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))) \
        & F.exists("v", lambda c: c != 0)
    usable = F.coalesce(sound, F.lit(False))
    classes = stage(given.where(usable).groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "vec-classes")
    sizes = classes.groupBy(F.size("v").alias("d")).agg(F.sum("copies").alias("n")).orderBy("d").collect()  # one row a length
    if not sizes:
        return given.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                            F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = None
    for r in sizes:
        part = _block_links(classes.where(F.size("v") == r.d), int(r.n), min_cos)
        found = part if found is None else found.unionByName(part)
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    # An id with several vectors is a member of several classes: it joins them.
    spread = stage(given.where(usable).groupBy("id").agg(F.min(F.xxhash64("v")).alias("lo"), F.max(F.xxhash64("v")).alias("hi"))
                   .where("lo <> hi").select(F.col("id").alias("s")), "vec-spread")
    member = given.where(usable).join(spread, F.col("id") == F.col("s"), "left_semi").select(F.col("id").alias("a"), F.col("v").alias("mv"))
    member = member.join(classes, F.col("mv") == F.col("v")).where("a <> id").select("a", F.col("id").alias("b")).distinct()
    comp = connected_components(found.where("root <> id").select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(member))
    by_class = classes.join(links.select(F.col("id").alias("l"), "n"), F.col("id") == F.col("l"), "left") \
        .join(comp, F.col("id") == F.col("node"), "left") \
        .select(F.col("v").alias("cv"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("comp", "id").alias("component_id"))
    good = given.where(usable).join(by_class, F.col("v") == F.col("cv")).select("id", "n_links", "component_id")
    rest = given.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return good.unionByName(rest).select(F.col("id").alias(id_col), "n_links", "component_id",
                                         F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


_SQL = """
with recursive v as (select vec_id, cast(embedding as double[]) as x from embeddings),
ok as (select * from v where x is not null and len(x) > 0 and list_bool_and([c is not null and isfinite(c) for c in x])
  and list_bool_or([c <> 0 for c in x])),
links as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.vec_id <> b.vec_id and len(a.x) = len(b.x)
  and list_cosine_similarity(a.x, b.x) >= 0.95),
reach(vec_id, c) as (select vec_id, vec_id from v union select r.vec_id, l.b from reach r join links l on l.a = r.c)
select v.vec_id, (select count(*) from links l where l.a = v.vec_id) as n_links, min(c) as component_id, min(c) = v.vec_id as kept
from v join reach r using (vec_id) group by v.vec_id
"""


@query("op6_pq_vector_near_dedup", _SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
