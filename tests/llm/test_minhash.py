import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import minhash as M
from strata.llm import words as W


def _expected(rows, k, num, den):
    sets, group = brute.near_groups([r[1] for r in rows], k, num, den)
    lowest = {}
    for (doc, *_), g in zip(rows, group):
        if doc is not None:
            lowest[g] = min(lowest.get(g, doc), doc)
    return sorted(((r[0], len(s), lowest.get(g)) for r, s, g in zip(rows, sets, group)), key=str)


@pytest.mark.parametrize("k,num", [(3, 85), (5, 80)])
def test_testdata_equals_brute_force(load, k, num):
    docs = load("documents")
    got = M.near_duplicates(docs, k, num, 100).select("doc_id", "n_shingles", "component_id").collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got), key=str) == _expected(rows, k, num, 100)


def test_odd_rows(odd_docs):
    got = M.near_duplicates(odd_docs, 3, 85, 100)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted((tuple(r)[:3] for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=str) \
        == _expected(rows, 3, 85, 100)
    assert {r.doc_id: r.kept for r in got.collect()}[3] is True  # empty texts are linked with nothing


def test_keep_one_row_a_group(odd_docs, no_docs):
    kept = M.keep_one(odd_docs, 3, 85, 100)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 10, 11, 3, 4, 5, 6, 8, None]
    assert {r._d for r in kept.collect()} == {"own _d"}
    assert M.near_duplicates(no_docs).count() == 0 and M.keep_one(no_docs).count() == 0


def test_unlike_texts_under_one_id_or_none_are_kept(spark):
    texts = [" ".join(f"{a}{i}" for i in range(20)) for a in "abcdef"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1] + " "), (None, texts[2]), (7, texts[3]), (7, texts[4]),
            (7, texts[4]), (8, texts[4]), (9, texts[5]), (None, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text.strip()) for r in M.keep_one(df, 3, 85, 100).collect()), key=str)
    assert kept == sorted([(None, t) for t in texts[:3]] + [(7, texts[3]), (7, texts[4]), (9, texts[5])], key=str)


def test_near_copies_linked_only_by_chains(spark):
    base = [f"w{i}" for i in range(100)]
    texts = []
    for step in range(8):  # each two words from the last; the ends are far apart
        texts.append(" ".join(base))
        base[step * 7], base[step * 7 + 3] = f"n{step}", f"m{step}"
    texts += [f"other text number {i} " * 3 for i in range(5)] + texts[:3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = M.near_duplicates(df, 3, 85, 100).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == _expected(list(enumerate(texts)), 3, 85, 100)


def test_many_groups_below_the_threshold(spark):
    """Copies of one text that share bands without being similar enough, with
    a few true links among them."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(120):
        t = list(base)
        for j in rng.choice(150, 14, replace=False):
            t[j] = f"v{i}x{j}"
        texts.append(" ".join(t))
        if i % 10 == 0:
            t[0] = "first"
            texts.append(" ".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = M.near_duplicates(df, 3, 85, 100).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == _expected(list(enumerate(texts)), 3, 85, 100)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\t", max_size=30), min_size=1, max_size=6))
def test_words_and_sets(texts):
    import pyarrow as pa
    buf, offsets = W.text_bytes(pa.array(texts))
    w = W.Words(buf, offsets, W.SPACED)
    assert w.counts.tolist() == [len(brute.spaced(t)) for t in texts]
    names = [x for t in texts for x in brute.spaced(t)]
    seen = {}
    assert all(seen.setdefault(h, x) == x for h, x in zip(w.hash.tolist(), names))
    assert len(set(names)) == len(seen)
    _, first = M.shingle_sets(w, 3)
    assert np.diff(first).tolist() == [len(brute.shingles(t, 3)) for t in texts]


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:340], rng.integers(0, 2**63, 60).astype(np.uint64)])
    for x, y in ((a, b), (a[:3], a[:3]), (a[:2], a[2:4])):
        sk = M.sketch(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), 512)
        assert (sk != np.uint64(2**64 - 1)).all()  # every coordinate is filled
        true = len(set(x.tolist()) & set(y.tolist())) / len(set(x.tolist()) | set(y.tolist()))
        assert abs((sk[0] == sk[1]).mean() - true) < .1
