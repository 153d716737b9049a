import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def load(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


#: Nulls, empty and very long texts, repeated rows, ties and columns whose
#: names the operators use themselves.
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD_DOCS = [
    (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "src1", 1),
    (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "src1", 1),
    (2, "THE quick brown fox jumps over the lazy dog again and again today", None, None, 2),
    (3, None, "en", "src0", 3), (4, "", "en", "src0", 4), (5, " \t\n ", "de", "src2", 5),
    (6, "one", "fr", "src3", 6), (7, "One", "fr", "src3", 7), (8, LONG, "en", "src4", 8),
    (9, LONG + " tail", "en", "src4", 9), (None, "nothing is known of this one at all", "es", "src5", 10),
    (10, "été à la plage 12 34 naïve 日本語 <|im_end|>", "fr", "x", 11), (11, "12 34 !!", "en", "src9", 12),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ODD_DOCS, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["x", "_x", "_d", "sig", "key", "bands", "_row", "score", "leaf", "full", "rest", "_bucket", "at", "size", "file", "row"]
    return df.withColumns({c: F.lit(f"own {c}") for c in clash})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
