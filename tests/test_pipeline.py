"""End to end on testdata-derived deposits: workbooks built from customer
rows -> ingest (bronze) -> newest per hash -> silver -> validate -> gate."""

import os

import pytest
from pyspark.sql import functions as F

from strata import jobs
from strata.operators import promote
from strata.plans.common import TESTDATA_DICTIONARY, nation_studies
from strata.plans.workbooks import customer_workbooks
from strata.sources.dictionary import dictionary_from_obj

SF = "/root/testdata/sf0.001"


def test_ingest_validate_gate(spark, tmp_dir):
    deposits = os.path.join(tmp_dir, "deposits")
    for r in customer_workbooks(spark, SF).collect():  # a handful of small files at sf0.001
        path = os.path.join(deposits, r.path.split("deposits/", 1)[1])
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as fh:
            fh.write(r.content)
    bronze_root = os.path.join(tmp_dir, "bronze")
    for run in ("run-1", "run-2"):  # the same deposits landed twice
        report = jobs.ingest(spark, "file://" + deposits, "file://" + bronze_root, batch_marker=run)
        assert report.count() > 0
    n_customers = spark.read.parquet(f"{SF}/customer.parquet").count()
    tables = sorted(os.listdir(bronze_root))
    bronze = None
    for t in tables:
        df = spark.read.option("mergeSchema", "true").parquet(os.path.join(bronze_root, t))
        bronze = df if bronze is None else bronze.unionByName(df, allowMissingColumns=True)
    assert bronze.count() == 2 * n_customers
    silver = promote.dedupe_bronze(bronze)
    assert silver.count() == n_customers
    assert [r[0] for r in silver.select("_src_batch_id").distinct().collect()] == ["run-2"]  # newest wins
    shaped = promote.silver_shape(silver, [
        ("c_custkey", "c_custkey", "bigint"), ("c_name", "c_name", None),
        ("c_nationkey", "nation__", "int"), ("c_acctbal", "c_acctbal", "double"),
        ("c_mktsegment", "c_mktsegment", None)])
    records = shaped.join(nation_studies(spark, SF), shaped.c_nationkey == F.col("n_nationkey")) \
        .withColumn("submitter_id", F.concat(F.lit("customer_"), F.col("c_custkey")))
    d = dictionary_from_obj(spark, TESTDATA_DICTIONARY)
    results = os.path.join(tmp_dir, "results")
    with pytest.raises(jobs.GateFailed) as err:
        jobs.validate(spark, {"customer": records}, d, results_path=results,
                      studies=records.select("study_id").distinct(), validation_id="v1")
    written = spark.read.parquet(results)
    enum_fails = written.filter("validator = 'enum'").count()
    furniture = spark.read.parquet(f"{SF}/customer.parquet").filter("c_mktsegment = 'FURNITURE'").count()
    assert enum_fails == furniture > 0
    assert err.value.signatures.count() > 0
