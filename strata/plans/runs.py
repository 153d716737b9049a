"""Catalogue: runs as a whole: incremental landing, the rows a run leaves when
its data or dictionary cannot be read, the root's link, the gate's policy and
the run's own identifiers (R1, P12, X15, V6, V7, E1, A3, X9, X10, X11)."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import jobs
from strata.functions import ids
from strata.operators import gate
from strata.plans.common import INGESTED_A, SCHEMA_VERSION, VALIDATION_NEW, customer_records, query, region_studies, table
from strata.plans.job_rows import _CUSTOMERS, _STUDY, _fresh
from strata.sinks import writers
from strata.sources.dictionary import dictionary_from_obj
from strata.streaming.landing import landing_failures, start_record_landing

# --- stream_landing: two deposits, a second run takes the new files alone -------------

@query("stream_landing", f"""
SELECT study_id, submitter_id, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'second-1' ELSE 'first-0' END AS batch, CAST(NULL AS VARCHAR) AS error FROM ({_CUSTOMERS})
UNION ALL SELECT {_STUDY}, NULL, NULL, NULL, 'second-1', 'not valid JSON' FROM region
""")
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _fresh(spark, "deposits")
    prefix, bronze, seen = f"{root}/submissions", f"{root}-bronze", f"{root}-checkpoint"
    c = customer_records(spark, sf_dir).withColumn("node", F.lit("customer"))
    line = F.to_json(F.struct("submitter_id", "c_custkey", "c_name"))

    second = c.filter("c_mktsegment = 'BUILDING'").select("study_id", "node", line.alias("value"))
    broken = region_studies(spark, sf_dir).select("study_id", F.lit("customer").alias("node"), F.lit("{broken").alias("value"))
    studies = [r.study_id for r in region_studies(spark, sf_dir).collect()]  # one folder a study
    for run, rows in (("first", c.filter("c_mktsegment <> 'BUILDING'").select("study_id", "node", line.alias("value"))),
                      ("second", second.unionByName(broken))):
        for s in studies:
            rows.filter(F.col("study_id") == s).select("value").write.mode("append").text(f"{prefix}/{s}/customer")
        start_record_landing(spark, root, bronze, run, INGESTED_A, checkpoint=seen).awaitTermination()
    out = None
    for s in studies:
        got = writers.read_bronze(spark, f"{bronze}/bronze_{s}_customer").select(
            F.col("_src_study_id").alias("study_id"), "submitter_id", "c_custkey", "c_name", F.col("_src_batch_id").alias("batch"),
            F.lit(None).cast("string").alias("error"))
        out = got if out is None else out.unionByName(got)
    null = F.lit(None).cast("string")
    lost = landing_failures(spark, f"{bronze}-findings", "second").select(
        "study_id", null.alias("submitter_id"), null.alias("c_custkey"), null.alias("c_name"), F.col("batch_id").alias("batch"), "error")
    return out.unionByName(lost)


# --- unreadable_study: one study's data cannot be read, all others are judged ----------

@query("unreadable_study", f"""
WITH f AS (SELECT study_id, 'FAIL' AS validation_result, submitter_id FROM ({_CUSTOMERS}) WHERE c_acctbal > 9000 AND study_id <> 'asia')
SELECT * FROM f UNION ALL SELECT 'asia', 'ERROR', NULL
UNION ALL SELECT {_STUDY}, 'PASS', NULL FROM region WHERE r_name <> 'ASIA' AND {_STUDY} NOT IN (SELECT study_id FROM f)
""")
def unreadable_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "results")
    torn = F.when(F.col("study_id") == "asia", F.raise_error(F.lit("torn file")).cast("double")).otherwise(F.col("c_acctbal"))
    rows = customer_records(spark, sf_dir).select("study_id", "submitter_id", torn.alias("c_acctbal"))
    d = dictionary_from_obj(spark, {"_version": SCHEMA_VERSION, "customer": {"properties": {"c_acctbal": {"maximum": 9000}}}})
    with contextlib.suppress(writers.PartialFailure):  # raised after everything is written
        jobs.validate(spark, {"customer": rows}, d, results_path=path, studies=region_studies(spark, sf_dir).select("study_id"),
                      validation_id=VALIDATION_NEW)
    return writers.read_results(spark, path).select("study_id", "validation_result", "submitter_id")


# --- broken_dictionary: a reference leads nowhere, so every study gets an ERROR row -------

@query("broken_dictionary", f"SELECT {_STUDY} AS study_id, 'ERROR' AS validation_result, TRUE AS named FROM region")
def broken_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "results")
    d = dictionary_from_obj(spark, {"_version": SCHEMA_VERSION, "customer": {"properties": {"c_name": {"$ref": "#/nowhere/name"}}}})
    with contextlib.suppress(ValueError):  # raised after the rows are written
        jobs.validate(spark, {"customer": customer_records(spark, sf_dir)}, d, results_path=path,
                      studies=region_studies(spark, sf_dir).select("study_id"), validation_id=VALIDATION_NEW)
    return writers.read_results(spark, path).select("study_id", "validation_result",
                                                    F.col("validation_error").contains("nowhere").alias("named"))


# --- root_link_policy: the root's missing link stands unless the policy lets it pass -------

_SPEC = {"_version": SCHEMA_VERSION, "customer": {"properties": {"c_mktsegment": {"enum": ["AUTOMOBILE", "HOUSEHOLD", "MACHINERY", "BUILDING"]}}}}


@query("root_link_policy", f"""
WITH r AS (SELECT study_id, count(*) AS n FROM ({_CUSTOMERS}) GROUP BY study_id),
e AS (SELECT study_id, count(*) AS n FROM ({_CUSTOMERS}) WHERE c_mktsegment = 'FURNITURE' GROUP BY study_id)
SELECT 'strict' AS gate, study_id, 'programs' AS invalid_key, n, 0 AS n_ignored, 'customer' AS exempt FROM r
UNION ALL SELECT 'strict', study_id, 'c_mktsegment', n, 0, 'customer' FROM e
UNION ALL SELECT 'lenient', study_id, 'c_mktsegment', n, 1, 'region' FROM e
""")
def root_link_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per policy; what each let pass is read back from its record."""
    d, out = dictionary_from_obj(spark, _SPEC), None
    for name, policy in (("strict", gate.GatePolicy(ignored_errors=(), exempt_nodes=("customer",))),
                         ("lenient", gate.GatePolicy(ignored_errors=("%programs%",), exempt_nodes=("region",)))):
        path = _fresh(spark, "results")
        with contextlib.suppress(jobs.GateFailed):  # raised after everything is written
            jobs.validate(spark, {"customer": customer_records(spark, sf_dir).select("study_id", "submitter_id", "c_mktsegment")}, d,
                          results_path=path, studies=region_studies(spark, sf_dir).select("study_id"), root_node="customer",
                          validation_id=VALIDATION_NEW, policy=policy, policy_path=f"{path}-policy")
        told = spark.read.parquet(f"{path}-policy").filter(F.col("validation_id") == VALIDATION_NEW).agg(
            F.count_if(F.col("setting") == "ignored_error").cast("int").alias("n_ignored"),
            F.max(F.when(F.col("setting") == "exempt_node", F.col("value"))).alias("exempt"))
        open_nodes = gate.GatePolicy(ignored_errors=policy.ignored_errors)
        found = gate.real_failures(writers.read_results(spark, path), open_nodes).groupBy("study_id", "invalid_key") \
            .agg(F.count(F.lit(1)).alias("n"))
        got = found.crossJoin(F.broadcast(told)).select(F.lit(name).alias("gate"), "study_id", "invalid_key", "n", "n_ignored", "exempt")
        out = got if out is None else out.unionByName(got)
    return out


# --- gate_failure_message: what the gate says when it stops a run ----------------------------

@query("gate_failure_message", f"""
SELECT count(*) AS n_signatures, string_agg(DISTINCT study_id, ',' ORDER BY study_id) AS studies
FROM (SELECT DISTINCT study_id, c_mktsegment FROM ({_CUSTOMERS}) WHERE c_mktsegment IN ('BUILDING', 'FURNITURE'))
""")
def gate_failure_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {"_version": SCHEMA_VERSION, "customer": {"properties": {"c_mktsegment": {"enum": ["AUTOMOBILE", "HOUSEHOLD", "MACHINERY"]}}}}
    rows = customer_records(spark, sf_dir).select("study_id", "submitter_id", "c_mktsegment")
    try:
        signatures = jobs.validate(spark, {"customer": rows}, dictionary_from_obj(spark, spec), results_path=_fresh(spark, "results"),
                                   studies=region_studies(spark, sf_dir).select("study_id"), validation_id=VALIDATION_NEW)
    except jobs.GateFailed as stopped:
        signatures = stopped.signatures
    return gate.gate_message(signatures)


# --- run_identifiers: stamps of a run that began when the newest order was made --------------

@query("run_identifiers", """
WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders)
SELECT o_orderpriority AS marker, strftime(d, '%Y-%m-%d') || 'T00:00:00+00:00' AS ingested_at, trim(o_orderpriority) AS batch_id,
       'local-' || strftime(d, '%Y%m%d') || 'T000000Z-' AS local_batch, strftime(d, '%Y%m%d') || 'T000000000000Z' AS validation_id
FROM (SELECT DISTINCT o_orderpriority FROM orders) CROSS JOIN m
""")
def run_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datetime import datetime, timezone
    orders = table(spark, sf_dir, "orders")
    day = orders.agg(F.max("o_orderdate").cast("date").alias("d")).first().d
    now = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
    rows = [(r.o_orderpriority, ids.ingested_at(now), ids.batch_id(f" {r.o_orderpriority} ", now), ids.batch_id(" ", now)[:-8],
             ids.validation_id(now)) for r in orders.select("o_orderpriority").distinct().collect()]  # five priorities
    return spark.createDataFrame(rows, "marker string, ingested_at string, batch_id string, local_batch string, validation_id string")
