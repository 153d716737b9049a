import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import merkle, queries
from strata.llm.common import ORACLES


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _leaf(r, more=0):
    n = None if r["n_chars"] is None else r["n_chars"] + more
    return H(*map(_field, (r["doc_id"], r["source"], r["lang"], n, r["text"])))


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def _path(levels, pos):
    for nodes in levels[:-1]:
        run = pos // 2 * 2
        yield pos % 2, [x for i, x in enumerate(nodes[run:run + 2]) if run + i != pos]
        pos //= 2


def brute(rows):
    """The contract's rows, by building every tree in full."""
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang),
                     key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
        trees[lang] = own, _levels([_leaf(r) for r in own])
    above = _levels([trees[x][1][-1][0] for x in langs])
    root = above[-1][0] if rows else None
    out = []
    for k, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, r in enumerate(own):
            steps = list(_path(levels, i)) + list(_path(above, k))
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            at = _leaf(r, int(bad))
            for bit, others in steps:
                at = H(*others, at) if bit else H(at, *others)
            out.append((r["doc_id"], levels[0][i], levels[-1][0], root, H(*[x for _, o in steps for x in o]), at, at == root))
    return out


def _rows(df):
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def _query(monkeypatch, spark, docs):
    monkeypatch.setattr(merkle, "table", lambda *a: docs)
    return merkle.op13(spark, "")


def test_odd_documents_match_full_trees(monkeypatch, spark, odd_docs):
    rows = [r.asDict() for r in odd_docs.collect()]
    assert _rows(_query(monkeypatch, spark, odd_docs)) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_trees_of_many_sizes(monkeypatch, spark, levels):
    # 1 to 41 leaves a language: lone leaves, lone last nodes, several rounds.
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "FAN", 1 << levels)
    sizes = [1, 2, 3, 5, 8, 9, 16, 17, 41]
    docs = spark.createDataFrame([(100 * k + i, f"t{i}", f"l{k}", "s", None if i % 5 == 0 else i) for k, n in enumerate(sizes) for i in range(n)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    rows = [r.asDict() for r in docs.collect()]
    want = brute(rows)
    assert _rows(_query(monkeypatch, spark, docs)) == sorted(want, key=str)
    assert any(not w[-1] for w in want) and any(w[-1] for w in want)


def test_whole_table(spark, load):
    rows = [r.asDict() for r in load("documents").collect()]
    got = queries.REGISTRY["op13_merkle_manifest"](spark, "/root/testdata/sf0.001")
    assert _rows(got) == sorted(brute(rows), key=str)


def test_some_requests_and_an_empty_table(spark, load, no_docs):
    made = merkle.Manifest(load("documents"))
    some = made.leaves.where("pos % 17 = 3").select("tree", "pos")
    got = made.proofs(some.unionByName(some).unionByName(spark.createDataFrame([("en", 10**9)], "tree string, pos long")))
    assert got.count() == some.count()
    back = got.withColumn("up", merkle.fold(F.col("digest"), F.col("path")))
    assert {r.up for r in back.collect()} == {made.root}
    empty = merkle.Manifest(no_docs)
    assert empty.root is None and empty.proofs(empty.leaves.select("tree", "pos")).count() == 0


def test_a_record_is_what_its_digest_names(spark, load):
    made = merkle.Manifest(load("documents"))
    for r in made.trees.records.select(F.explode("records").alias("r")).select("r.*").collect():
        assert r.digest == H(*r.children) and 1 <= len(r.children) <= 2
    assert "op13_merkle_manifest" in ORACLES
