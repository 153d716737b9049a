import brute
import numpy as np

from strata.llm import winnow as X


def _check(docs, items):
    rows, its = docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect()
    want = brute.contamination([r.text for r in rows], [("" if i.item_id is None else i.item_id, i.text) for i in its])
    got = X.contamination(docs, items).select("doc_id", "n_words", "n_hit", "items").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(
        ((r.doc_id, n, h, ids) for r, (n, h, ids) in zip(rows, want)), key=str)
    return got


def test_testdata_equals_brute_force(load):
    assert any(r.n_hit for r in _check(load("documents"), load("benchmark")))


def test_odd_documents_and_items(spark, odd_docs, no_docs):
    words = [f"k{i}" for i in range(40)]
    items = spark.createDataFrame([
        (1, "jumps over the lazy"), (2, "one"), (3, None), (4, ""), (5, " ".join(words)), (5, " ".join(words)),
        (None, "nothing is known"), (6, " ".join(["same"] * 30)), (7, " ".join(words[5:15])), (10, "34 naïve 日本語"),
    ], "item_id long, text string").selectExpr("*", "1 as x", "2 as hits", "3 as size")
    docs = spark.createDataFrame([
        (100, " ".join(["pre"] * 7 + words[3:14] + ["post"])), (101, " ".join(words[:9])), (102, " ".join(["same"] * 50)),
        (103, " ".join(words) + " " + " ".join(words)), (104, "x " * 30 + " ".join(words[10:20]))], "doc_id long, text string")
    _check(odd_docs.select("doc_id", "text").unionByName(docs), items)
    _check(odd_docs, items)
    assert X.contamination(no_docs, items).count() == 0
    assert all(r.n_hit == 0 for r in X.contamination(odd_docs, items.where("false")).collect())
    kept = X.drop_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [11, 3, 4, 5, 8, 9]


def test_every_shared_span_shares_a_fingerprint():
    rng = np.random.default_rng(5)
    for _ in range(50):
        span = rng.integers(0, 50, X.SPAN).astype(np.uint64)
        a = np.concatenate([rng.integers(0, 50, 30).astype(np.uint64), span, rng.integers(0, 50, 9).astype(np.uint64)])
        b = np.concatenate([span, rng.integers(50, 99, 20).astype(np.uint64)])
        _, pa = X.fingerprints(a, np.array([0, len(a)]))
        _, pb = X.fingerprints(b, np.array([0, len(b)]))
        _, ps = X.fingerprints(span, np.array([0, X.SPAN]))
        assert set(ps.tolist()) <= set(pa.tolist()) & set(pb.tolist())
