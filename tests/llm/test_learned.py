"""Quality and language: held-out accuracy, the chain's algebra, odd rows."""

import itertools

import numpy as np

from strata.llm import langid, quality

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score(docs.select("doc_id", "text"), quality.train(docs, labels)) \
        .where(quality.fold_of("doc_id", 5) == 0).join(labels, "doc_id").select("score", "quality").collect()
    right = [(r.score >= quality.THRESHOLD) == (r.quality == 1) for r in got]
    assert len(right) > 50 and np.mean(right) > .95
    assert all(r.score >= quality.THRESHOLD for r in got if r.quality == 1)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    unary, trans, first = rng.normal(size=7), rng.normal(size=(2, 2)), np.array([0, 4, 5, 7])
    p, joint = quality.marginals(unary, trans, first, True, np.ones(7))
    want_p, want_j = np.zeros(7), np.zeros((2, 2))
    for lo, hi in zip(first[:-1], first[1:]):
        total, weights = 0, []
        for ys in itertools.product((0, 1), repeat=hi - lo):
            s = np.exp(sum(y * unary[lo + i] for i, y in enumerate(ys)) + sum(trans[a, b] for a, b in zip(ys, ys[1:])))
            weights.append((ys, s))
            total += s
        for ys, s in weights:
            want_p[lo:hi] += np.array(ys) * s / total
            for a, b in zip(ys, ys[1:]):
                want_j[a, b] += s / total
    assert np.allclose(p, want_p) and np.allclose(joint, want_j)


def test_lines_and_features():
    import pyarrow as pa

    from strata.llm import words as W
    texts = ["a b\n\nTHE | x |\n", "", "go go go go", "\n"]
    x, size, first = quality.line_features(*W.text_bytes(pa.array(texts)))
    assert np.diff(first).tolist() == [4, 1, 1, 2]
    assert size.tolist() == [3, 0, 9, 0, 0, 11, 0, 0]
    assert x[5, 7] == 1 and x[0, 7] == 0 and x[2, 3] == 1
    full = quality.with_neighbours(x, first)
    assert (full[0, 13:26] == 0).all() and (full[1, 13:26] == x[0]).all() and (full[3, 26:] == 0).all()


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (8, 1, 0), (None, 0, 0), (9, None, 0), (10, 0, 1)],
                                   "doc_id long, quality int, toxic int").selectExpr("*", "'own' as text", "1 as x")
    model = quality.train(odd_docs, labels)
    got = quality.score(odd_docs, model)
    assert set(got.columns) == set(odd_docs.columns) and got.count() == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert quality.score(no_docs, model).count() == 0
    nothing = quality.train(odd_docs, labels.where("false"))
    assert {r.score for r in quality.score(odd_docs, nothing).collect()} == {.5}


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predict(docs, langid.train(docs)).where(quality.fold_of("doc_id", 3) == 1) \
        .join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 200 and np.mean([r.lang == r.lang_pred for r in got]) > .97


def test_language_odd_rows(odd_docs, no_docs):
    model = langid.train(odd_docs)
    got = {r.doc_id: r for r in langid.predict(odd_docs, model).collect()}
    assert {k for k, r in got.items() if r.lang_pred == "und"} == {3, 4, 5, 11}
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.predict(no_docs, model).count() == 0
    assert {r.lang_pred for r in langid.predict(odd_docs, langid.train(no_docs)).collect()} == {"und"}


def test_families_then_pairs():
    rng = np.random.default_rng(0)
    x = np.zeros((80, langid.BUCKETS))
    lang = np.repeat(np.arange(4), 20)
    for i, l in enumerate(lang):
        x[i, l * 10:(l + 1) * 10] = rng.random(10)
    m = langid.Model(["de", "en", "es", "xx"], x, lang)
    assert m.family_names == ["germanic", "romance", "xx"] and m.pairs == [("germanic", 0, 1)]


def test_copies_of_a_text_count_once_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_PER_LANG", 40)
    monkeypatch.setattr(langid, "Model", lambda *parts: parts)
    texts = ["a copied text"] * 3000 + [f"english {chr(97 + i % 26) * (1 + i // 26)}w text" for i in range(90)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(9000 + i, f"ein deutscher satz {i}", "de") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for _ in range(2):  # the same sample each time
        langs, x, lang = langid.train(docs)
        assert langs == ["de", "en"] and (lang == 1).sum() == 40 == len(np.unique(x[lang == 1], axis=0))
    assert (x == langid.train(docs.repartition(7))[1]).all()
    monkeypatch.setattr(langid, "MAX_SAMPLE", 30)
    assert np.bincount(langid.train(docs)[2]).tolist() == [15, 15]
