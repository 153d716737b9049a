"""Merkle manifest of a dataset: a content-addressed DAG with proofs by descent.

Per language the leaves stand in doc_id order; every two consecutive nodes
become one, until one is left, and the languages' nodes are joined in the same
way. The store maps a digest to its children. Subtrees of up to ``LEVELS``
levels are one row of the store, named by the digest on top, so a request
passes ``LEVELS`` levels of records with each join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import query, stage, table
from strata.operators.positions import ranked

#: Levels of the tree in one row of the store: at most 2^LEVELS leaves each.
LEVELS = 8
FAN = 1 << LEVELS
_HASH = hashlib.sha256


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """A document's digest (lower-case hex)."""
    return F.sha2(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def _parent(children: list[str]) -> str:
    return _HASH("".join(children).encode()).hexdigest()


# ------------------------------------------------------------------- building

_RECORD = "array<struct<digest:string,children:array<string>>>"


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tree, pos, depth, nodes) -> (tree, pos, digest, records): the
    subtree of ``depth`` levels over the nodes, one record a digest."""
    for b in batches:
        tops, sizes, digests, children, kids = [], [0], [], [], [0]
        for nodes, depth in zip(b.column("nodes").to_pylist(), b.column("depth").to_pylist()):
            seen: dict[str, list[str]] = {}
            for _ in range(depth):
                pairs = [nodes[i:i + 2] for i in range(0, len(nodes), 2)]
                nodes = [_parent(p) for p in pairs]
                seen.update(zip(nodes, pairs))
            tops.append(nodes[0])
            sizes.append(sizes[-1] + len(seen))
            for digest, pair in seen.items():
                digests.append(digest)
                children.extend(pair)
                kids.append(len(children))
        records = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(kids, pa.int32()), pa.array(children, pa.string()))],
            names=["digest", "children"]))
        yield pa.RecordBatch.from_arrays([b.column("tree"), b.column("pos"), pa.array(tops, pa.string()), records],
                                         names=["tree", "pos", "digest", "records"])


def _height(n: str) -> Column:
    """Levels above n nodes: the least h with 2^h >= n."""
    return F.when(F.col(n) > 1, F.length(F.bin(F.col(n) - 1))).otherwise(0)


class Store:
    """The trees over (tree, pos, digest): ``records`` (digest, records; one
    row a subtree), ``tops`` (tree, n, digest) and the number of ``rounds``
    of subtrees that stand above one another.

    Positions run from 0 without a gap in each tree; null is a tree like any
    other. Equal subtrees have the same digest and one row.
    """

    def __init__(self, nodes: DataFrame):
        sizes = stage(nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "tree-sizes")
        most = sizes.agg(F.max("n")).first()[0] or 0
        grown: list[DataFrame] = []
        tops = nodes
        for self.rounds in range(64 // LEVELS + 1):
            if most <= FAN ** self.rounds and self.rounds:
                break
            lo = self.rounds * LEVELS
            # A tree that has reached its top hands it on unchanged (depth 0).
            depth = F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.col("h") - lo)).cast("int")
            runs = tops.select("tree", F.shiftright("pos", LEVELS).alias("pos"), F.struct("pos", "digest").alias("x")) \
                .groupBy("tree", "pos").agg(F.sort_array(F.collect_list("x")).alias("x"))
            rise = sizes.select(F.col("tree").alias("t"), _height("n").alias("h"))
            runs = runs.join(rise, F.col("tree").eqNullSafe(F.col("t"))) \
                .select("tree", "pos", depth.alias("depth"), F.col("x.digest").alias("nodes"))
            grown.append(stage(runs.mapInArrow(_grow, f"tree string, pos long, digest string, records {_RECORD}"), "subtrees"))
            tops = grown[-1].select("tree", "pos", "digest")
        records = grown[0].select("digest", "records").where(F.size("records") > 0)
        for g in grown[1:]:
            records = records.unionByName(g.select("digest", "records").where(F.size("records") > 0))
        self.records = records.groupBy("digest").agg(F.first("records").alias("records"))
        self.tops = stage(tops.join(sizes.withColumnRenamed("tree", "t"), F.col("tree").eqNullSafe(F.col("t")))
                          .select("tree", "n", "digest"), "tops")


# -------------------------------------------------------------------- descent

#: A step of a proof: the sibling and whether it stands on the left; a node
#: alone in its run has none (null).
PROOF = "array<struct<left:boolean,sibling:string>>"


def _walk(batches: Iterator[pa.RecordBatch], depth_of: str) -> Iterator[pa.RecordBatch]:
    """From the digest on top of a store row down to each wanted position,
    by its binary digits; what is not selected is added to the path, which is
    reversed at the end of the segment (nearest sibling first)."""
    kind = pa.struct([("left", pa.bool_()), ("sibling", pa.string())])
    for b in batches:
        rows = zip(b.column("digest").to_pylist(), b.column("records").to_pylist(), b.column(depth_of).to_pylist(),
                   b.column("path").to_pylist(), b.column("digits").to_pylist())
        parent, digits, reached, paths = [], [], [], []
        for i, (top, records, depth, path, wanted) in enumerate(rows):
            children = {r["digest"]: r["children"] for r in records or ()}
            for digit in wanted:
                at, segment = top, []
                for level in range(depth - 1, -1, -1):
                    pair = children[at]
                    bit = digit >> level & 1
                    at = pair[bit]
                    segment.append({"left": bool(bit), "sibling": pair[1 - bit] if len(pair) > 1 else None})
                parent.append(i)
                digits.append(digit)
                reached.append(at)
                paths.append(segment[::-1] + path)
        take = pa.array(parent, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [b.column("tree").take(take), b.column("pos").take(take), pa.array(digits, pa.int64()), pa.array(reached, pa.string()),
             pa.array(paths, pa.list_(kind))], names=["tree", "pos", "digit", "digest", "path"])


def prove(store: Store, requests: DataFrame, tops: DataFrame | None = None) -> DataFrame:
    """(tree, pos, digest, path) for every distinct requested (tree, pos):
    the digest that the descent reaches and the proof from it to the top.

    ``tops`` (tree, n, digest, path) says where each tree's descent starts; a
    path given there is what leads on from its top. Positions that agree in
    their leading digits share the way down: a row of the store is met once,
    with at most 2^LEVELS distinct continuations. Requests outside a tree give
    no row.
    """
    start = tops if tops is not None else store.tops.withColumn("path", F.expr(f"cast(array() as {PROOF})"))
    at = start.select("tree", "n", _height("n").alias("h"), F.lit(0).cast("long").alias("pos"), "digest", "path")
    known = requests.select("tree", "pos").distinct().join(
        start.select(F.col("tree").alias("t"), "n"), F.col("tree").eqNullSafe(F.col("t")) & F.col("pos").between(0, F.col("n") - 1)) \
        .select("tree", "pos")
    known = stage(known, "requests")
    for k in range(store.rounds - 1, -1, -1):
        lo = k * LEVELS
        wanted = known.select(F.col("tree").alias("t"), F.shiftright("pos", lo).alias("p")).distinct() \
            .groupBy("t", F.shiftright("p", LEVELS).alias("up")) \
            .agg(F.sort_array(F.collect_list(F.col("p").bitwiseAND(FAN - 1))).alias("digits"))
        here = at.join(wanted, F.col("tree").eqNullSafe(F.col("t")) & (F.col("pos") == F.col("up"))).drop("t", "up")
        depth = F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.col("h") - lo)).cast("int")
        met = here.join(store.records, "digest", "left") \
            .select("tree", "pos", "digest", "records", depth.alias("depth"), "path", "digits")
        down = met.mapInArrow(partial(_walk, depth_of="depth"),
                              f"tree string, pos long, digit long, digest string, path {PROOF}")
        down = down.select("tree", (F.col("pos") * FAN + F.col("digit")).alias("pos"), "digest", "path")
        if k:
            size = start.select(F.col("tree").alias("t"), "n", _height("n").alias("h"))
            at = stage(down.join(size, F.col("tree").eqNullSafe(F.col("t"))).select("tree", "n", "h", "pos", "digest", "path"), "way")
        else:
            at = down
    return at


def fold(digest: Column, path: Column) -> Column:
    """The digest on top that a leaf and its proof lead to."""
    return F.aggregate(path, digest, lambda acc, s: F.sha2(
        F.when(s.sibling.isNull(), acc).when(s.left, F.concat(s.sibling, acc)).otherwise(F.concat(acc, s.sibling)), 256))


# ------------------------------------------------------------------- manifest

class Manifest:
    """The manifest of ``docs`` (doc_id, text, lang, source, n_chars).

    ``leaves``: doc_id, tree (lang), pos, leaf and whatever columns ``extra``
    names (expressions over the documents). ``subroots``: tree, pos (rank of
    the language, null first, bytewise), digest. ``root``: the digest of all.

    Null values are ``-`` in a leaf and a null lang is a tree of its own, the
    first. Null doc_ids come first in their tree; rows that share a doc_id
    stand in the order of their digests, and repeated rows are leaves each.
    An empty table has no root (None). Further columns are not part of it.
    """

    def __init__(self, docs: DataFrame, extra: dict[str, Column] | None = None):
        digest = leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
        rows = stage(docs.select("doc_id", F.col("lang").alias("tree"), digest.alias("leaf"),
                                 *[c.alias(n) for n, c in (extra or {}).items()]), "leaves")
        self.leaves = stage(ranked(rows, ["doc_id", "leaf"], ["tree"], "pos"), "ranked-leaves")
        self.trees = Store(self.leaves.select("tree", "pos", F.col("leaf").alias("digest")))
        langs = ranked(self.trees.tops, ["tree"], (), "pos")
        self.subroots = stage(langs.select("tree", "pos", "digest"), "subroots")
        self.above = Store(self.subroots.select(F.lit("").alias("tree"), "pos", "digest"))
        top = self.above.tops.first()
        self.root = top.digest if top else None

    def proofs(self, requests: DataFrame) -> DataFrame:
        """(tree, pos, digest, path) for the requested leaves, by descent from
        the root: through the languages, then through the language's tree."""
        lead = prove(self.above, self.subroots.select(F.lit("").alias("tree"), "pos"))
        named = lead.select("pos", F.col("digest").alias("top"), F.col("path").alias("lead"))
        tops = self.trees.tops.alias("t").join(self.subroots.select(F.col("tree").alias("l"), "pos"), F.col("tree").eqNullSafe(F.col("l"))) \
            .join(named, "pos").select("tree", "n", F.col("top").alias("digest"), F.col("lead").alias("path"))
        return prove(self.trees, requests, stage(tops, "starts"))


_SQL = """
with recursive f as (select doc_id, lang, n_chars,
  case when doc_id is null then '-' else strlen(cast(doc_id as varchar)) || ':' || doc_id end
  || case when source is null then '-' else strlen(source) || ':' || source end
  || case when lang is null then '-' else strlen(lang) || ':' || lang end as a,
  case when text is null then '-' else strlen(text) || ':' || text end as b from documents),
g as (select doc_id, lang, a, b, n_chars, sha256(a || case when n_chars is null then '-' else strlen(cast(n_chars as varchar)) || ':' || n_chars end || b) as leaf,
  sha256(a || case when n_chars is null then '-' else strlen(cast(n_chars + 1 as varchar)) || ':' || (n_chars + 1) end || b) as other from f),
l as (select doc_id, lang, leaf, other, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos from g),
t(lang, lev, nodes) as (
  select lang, 0, list(leaf order by pos) from l group by lang
  union all
  select lang, lev + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], '')))
  from t where len(nodes) > 1),
tops as (select lang, lev as h, nodes[1] as subroot from t where len(nodes) = 1),
ranks as (select *, row_number() over (order by lang nulls first) - 1 as lpos from tops),
u(lev, nodes) as (
  select 0, list(subroot order by lpos) from ranks
  union all
  select lev + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) from u where len(nodes) > 1),
rt as (select lev as rh, nodes[1] as root from u where len(nodes) = 1),
tab as (select i, list_reduce(list_prepend(cast(i as bigint), range(8)), lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end) as v from range(256) q(i)),
tabs as (select list(v order by i) as v from tab),
tam as (select doc_id, xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(1, strlen(cast(doc_id as varchar)) + 1),
  lambda i: cast(ascii(substr(cast(doc_id as varchar), i, 1)) as bigint))),
  lambda x, y: xor(x // 256, v[(xor(x, y) & 255) + 1])), 4294967295) % 7 = 0 as bad from (select distinct doc_id from documents where doc_id is not null), tabs),
steps as (
  select l.doc_id, l.leaf, l.lang, l.pos, t.lev, (l.pos >> t.lev) % 2 as bit, t.nodes[xor(l.pos >> t.lev, 1) + 1] as sib
  from l join t on l.lang is not distinct from t.lang where len(t.nodes) > 1
  union all
  select l.doc_id, l.leaf, l.lang, l.pos, 1000 + u.lev, (r.lpos >> u.lev) % 2, u.nodes[xor(r.lpos >> u.lev, 1) + 1]
  from l join ranks r on l.lang is not distinct from r.lang, u where len(u.nodes) > 1),
proof as (select lang, pos, list({'bit': bit, 'sib': sib} order by lev) as path, string_agg(coalesce(sib, ''), '' order by lev) as joined
  from steps group by lang, pos),
start as (select l.lang, l.pos, l.doc_id, l.leaf, coalesce(bad, false) as bad, l.other, coalesce(p.path, []) as path, coalesce(joined, '') as joined
  from l left join proof p on p.pos = l.pos and p.lang is not distinct from l.lang left join tam on tam.doc_id = l.doc_id),
walk(lang, pos, i, acc) as (
  select lang, pos, 0, case when bad then other else leaf end from start
  union all
  select w.lang, w.pos, i + 1, sha256(case when s.path[i + 1].sib is null then acc when s.path[i + 1].bit = 1 then s.path[i + 1].sib || acc else acc || s.path[i + 1].sib end)
  from walk w join start s on s.pos = w.pos and s.lang is not distinct from w.lang where i < len(s.path))
select s.doc_id, s.leaf, subroot, root, sha256(joined) as proof_sha256, w.acc as folded_root, w.acc = root as verified
from start s join walk w on w.pos = s.pos and w.lang is not distinct from s.lang and w.i = len(s.path)
join tops on tops.lang is not distinct from s.lang, rt
"""


@query("op13_merkle_manifest", _SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A tampered document differs in its n_chars alone; only its leaf changes.
    other = leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    made = Manifest(table(spark, sf_dir, "documents"), {"claimed": F.when(tampered, other)})
    proofs = made.proofs(made.leaves.select("tree", "pos")).select(F.col("tree").alias("t"), F.col("pos").alias("p"), "digest", "path")
    proofs = proofs.select("*", F.sha2(F.array_join(F.filter("path.sibling", lambda s: s.isNotNull()), ""), 256).alias("proof_sha256"))
    rows = made.leaves.join(proofs, F.col("tree").eqNullSafe(F.col("t")) & (F.col("pos") == F.col("p")))
    subroots = made.subroots.select(F.col("tree").alias("s"), F.col("digest").alias("subroot"))
    root = F.lit(made.root).cast("string")
    return rows.join(subroots, F.col("tree").eqNullSafe(F.col("s"))) \
        .select("doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), "proof_sha256",
                fold(F.coalesce("claimed", "leaf"), F.col("path")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
