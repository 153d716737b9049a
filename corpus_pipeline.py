"""A corpus pipeline of the training-data operators: quality, near-dedup,
decontamination, mixture, token output.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next one's ``docs``, so a lost executor never costs more
than the stage it worked on. All stages but the last return the columns of
``documents``; the last returns the index of the token files it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import minhash, mixing, quality, tokens, winnow
from strata.llm.common import stage, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF does not reject (score >= THRESHOLD)."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    row = docs.select(F.struct("*").alias("_row"), "text")
    return quality.score(row, model).where(F.col("score") >= quality.THRESHOLD).select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked at 5-word shingle similarity 0.8."""
    return minhash.keep_one(docs, k=5, num=80, den=100)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return winnow.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights; a document drawn in several
    epochs is a row in each."""
    return mixing.mix_documents(docs).select(*docs.columns)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, read back from the ORC files."""
    return tokens.token_output(docs, tokens.default_tokenizer())


STAGES = [
    ("quality classifier", keep_good),
    ("minhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("source mixture", mix_sources),
    ("token output", write_token_ids),
]

#: A trained classifier and a sketch are not SQL; tests hold every stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
