"""Every stage of the corpus pipeline against a brute-force version of it."""

import brute
import corpus_pipeline as P
import pytest
from test_mixing import _brute as mixture
from test_mixing import _domain
from test_tokens import _expected as token_rows

from strata.llm import mixing, quality, tokens

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, step in P.STAGES:
        got = P.stage(step(spark, docs, SF), name.replace(" ", "-"))
        out.append((docs.collect(), got.collect(), got.columns))
        docs = got
    return out


def test_stages_are_the_five_in_order_and_keep_the_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "minhash near-dedup", "benchmark decontamination",
                                        "source mixture", "token output"]
    assert all(cols == COLUMNS for _, _, cols in stages[:-1])


def test_quality_keeps_good_documents(spark, stages):
    before, after, _ = stages[0]
    kept = {r.doc_id for r in after}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.doc_id in kept for r in before if label.get(r.doc_id) == 1)
    bad = [r.doc_id for r in before if label.get(r.doc_id) == 0]
    assert sum(d in kept for d in bad) <= .2 * len(bad)
    model = quality.train(spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long"),
                          spark.read.parquet(f"{SF}/labels.parquet"))
    assert model[0].any()


def test_one_document_of_each_near_duplicate_group(stages):
    before, after, _ = stages[1]
    _, group = brute.near_groups([r.text for r in before], 5, 80, 100)
    lowest = {}
    for r, g in zip(before, group):
        lowest[g] = min(lowest.get(g, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(lowest.values()) and len(after) < len(before)


def test_contaminated_documents_go(spark, stages):
    before, after, _ = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r for r, (_, hit, _) in zip(before, brute.contamination([r.text for r in before], items)) if not hit]
    assert sorted(map(tuple, after)) == sorted(map(tuple, clean)) and len(after) < len(before)


def test_mixture(stages):
    before, after, _ = stages[3]
    assert sorted(r.doc_id for r in after) == sorted(r[0] for r in mixture(before, mixing.MIX, _domain))


def test_token_output(stages):
    from tokenizers import Tokenizer
    before, after, _ = stages[4]
    rows = sorted(((r.doc_id, r.text) for r in before))
    want = token_rows(Tokenizer.from_file(tokens.default_tokenizer()), rows)
    assert sorted(map(tuple, after)) == sorted(want)


def test_run_is_the_stages(spark, stages):
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][1]))


def test_odd_and_empty_documents_pass_every_stage(spark, odd_docs, no_docs):
    for given in (odd_docs, no_docs):
        docs = given
        for name, step in P.STAGES[:-1]:
            docs = P.stage(step(spark, docs, SF), name.replace(" ", "-"))
            assert set(docs.columns) == set(given.columns), name
        assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count()
