"""Catalogue: appends and exports that lose no row, the commit manifest, pins
and greatest partitions of stored tables (K3, K4, K6, V10, J8, S10, S11, A4, W4)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import jobs
from strata.operators import checks, gate, release, tables
from strata.plans.common import VALIDATION_NEW, VALIDATION_OLD, customer_records, query, table
from strata.plans.job_rows import _CUSTOMERS, _fresh
from strata.sinks import buckets, manifest, schema_ledger, writers
from strata.sources import records, snapshots
from strata.sources.dictionary import links_frame


def _results(df: DataFrame, vid: str, error) -> DataFrame:
    own = {"validation_id": F.lit(vid), "index": F.lit(None).cast("bigint"), "study_id": F.col("study_id"),
           "validation_result": F.lit("FAIL"), "validation_error": error, "submitter_id": F.col("submitter_id")}
    return df.select(*[own.get(c, F.lit(None).cast("string")).alias(c) for c in checks.RESULT_COLUMNS])


# --- results_two_appends: two appends under one id, both complete, one replayed ---------

@query("results_two_appends", f"""
SELECT study_id, submitter_id, 'negative' AS validation_error, 2 AS n_units, 2 AS n_complete FROM ({_CUSTOMERS}) WHERE c_acctbal < 0
UNION ALL SELECT study_id, submitter_id, 'large', 2, 2 FROM ({_CUSTOMERS}) WHERE c_acctbal > 9000
""")
def results_two_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, c = _fresh(spark, "results"), customer_records(spark, sf_dir)
    writers.append_results(_results(c.filter("c_acctbal < 0"), VALIDATION_NEW, F.lit("negative")), path, run_key="a")
    for _ in range(2):
        writers.append_results(_results(c.filter("c_acctbal > 9000"), VALIDATION_NEW, F.lit("large")), path, run_key="b")
    told = manifest.audit(spark, path, writers.RESULTS_UNIT).agg(
        F.count(F.lit(1)).cast("int").alias("n_units"), F.count_if(F.col("status") == "complete").cast("int").alias("n_complete"))
    return writers.read_results(spark, path).select("study_id", "submitter_id", "validation_error").crossJoin(F.broadcast(told))


# --- release_two_databases: models of one name in two gold databases ----------------------

@query("release_two_databases", """
SELECT 'a_gold_db' AS db_name, 'customer' AS write_table, '{"c_custkey":' || c_custkey || '}' AS value FROM customer WHERE c_acctbal > 0
UNION ALL SELECT 'b_gold_db', 'customer', '{"c_custkey":' || c_custkey || '}' FROM customer WHERE c_acctbal <= 0
""")
def release_two_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, c = _fresh(spark, "export"), table(spark, sf_dir, "customer")
    led = spark.createDataFrame([("1.0", db, "gold_s_customer", 1, "sha") for db in ("a_gold_db", "b_gold_db")],
                                "release_tag string, db_name string, model_name string, snapshot_id long, github_sha string")

    def model(db: str, name: str) -> DataFrame:
        return c.filter("c_acctbal > 0" if db.startswith("a") else "c_acctbal <= 0").select("c_custkey", F.lit(1).alias("snapshot_id"))
    order = release.import_order(spark, links_frame(spark, [("customer", "nation")]))
    for _ in range(2):  # exported again: the same records
        jobs.export_release(spark, led, model, path, order)
    return manifest.read_committed(spark, f"{path}/release_jsons", writers.EXPORT_UNIT, "text").select("db_name", "write_table", "value")


# --- commit_audit: a unit half lost, one written over, one never committed ------------------

@query("commit_audit", """
WITH s AS (SELECT o_orderstatus AS st, count(*) AS n, count(*) FILTER (o_orderkey % 2 = 0) AS half FROM orders GROUP BY 1)
SELECT 'same-' || st AS part, n AS committed, n AS found, 'complete' AS status FROM s
UNION ALL SELECT 'half-' || st, n, half, 'differs' FROM s
UNION ALL SELECT 'gone-' || st, n, NULL, 'missing' FROM s
UNION ALL SELECT 'late-' || st, NULL, n, 'uncommitted' FROM s
""")
def commit_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, o = _fresh(spark, "units"), table(spark, sf_dir, "orders")
    status = [r[0] for r in o.select("o_orderstatus").distinct().collect()]

    def part(kind: str, df: DataFrame = o) -> DataFrame:
        return df.select("o_orderkey", "o_totalprice", F.concat(F.lit(kind + "-"), "o_orderstatus").alias("part"))
    for kind in ("same", "half", "gone"):
        manifest.write_committed(part(kind), path, ["part"], [[f"{kind}-{s}"] for s in status], run_key=kind)
    # What a lost executor or a second writer would leave behind.
    later = part("late").unionByName(part("half", o.filter("o_orderkey % 2 = 0")))
    later.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    for s in status:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{snapshots.partition_folder('part', f'gone-{s}')}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return manifest.audit(spark, path, ["part"]).select(F.get_json_object("unit", "$.part").alias("part"), "committed", "found", "status")


# --- pinned_partitions: ledger pins over a stored, partitioned table (dynamic pruning) --------


def write_models(spark: SparkSession, sf_dir: str) -> str:
    """Gold models at several snapshots: table_name=/snapshot_id= folders."""
    path, o = _fresh(spark, "gold"), table(spark, sf_dir, "orders")
    o.withColumn("table_name", F.concat(F.lit("gold_"), F.lower("o_orderstatus"), F.lit("_orders"))) \
        .withColumn("snapshot_id", F.explode(F.array(*[F.lit(i) for i in (1, 2, 10)]))) \
        .filter("o_orderkey % 10 < snapshot_id").select("o_orderkey", "o_totalprice", "table_name", "snapshot_id") \
        .write.partitionBy("table_name", "snapshot_id").parquet(path)
    return path


@query("pinned_partitions", """
WITH l AS (SELECT * FROM (VALUES ('1.0', 'gold_f_orders', 1), ('1.0', 'gold_o_orders', 2), ('1.1', 'gold_f_orders', 10), ('1.1', 'gold_p_orders', 1))
           t(release_tag, model_name, snapshot_id))
SELECT model_name AS table_name, l.snapshot_id, o_orderkey, o_totalprice
FROM l JOIN orders ON model_name = 'gold_' || lower(o_orderstatus) || '_orders' AND o_orderkey % 10 < l.snapshot_id WHERE release_tag = '1.1'
""")
def pinned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = spark.read.parquet(write_models(spark, sf_dir))
    ledger_path = _fresh(spark, "ledger")
    spark.createDataFrame([("1.0", "gold_f_orders", 1), ("1.0", "gold_o_orders", 2), ("1.1", "gold_f_orders", 10), ("1.1", "gold_p_orders", 1)],
                          "release_tag string, table_name string, snapshot_id int").write.parquet(ledger_path)
    pins = spark.read.parquet(ledger_path).filter("release_tag = '1.1'").select("table_name", F.col("snapshot_id").cast("string").alias("snapshot_id"))
    got = release.read_pinned(models.withColumn("snapshot_id", F.col("snapshot_id").cast("string")), pins, ("table_name",))
    return got.select("table_name", F.col("snapshot_id").cast("int").alias("snapshot_id"), "o_orderkey", "o_totalprice")


# --- greatest_by_listing: latest snapshot of every table, from folder names --------------------


@query("greatest_by_listing", """
SELECT 'gold_' || lower(o_orderstatus) || '_orders' AS table_name, 10 AS snapshot_id, count(*) AS n FROM orders GROUP BY 1
""")
def greatest_by_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_models(spark, sf_dir)
    latest = release.latest_snapshots(snapshots.snapshot_listing(spark, path))
    parts = [snapshots.read_greatest(spark, f"{path}/table_name={r.table_name}", "snapshot_id", key=int)
             .withColumn("table_name", F.lit(r.table_name)) for r in latest.collect()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("table_name", F.col("snapshot_id").cast("int").alias("snapshot_id")).agg(F.count(F.lit(1)).alias("n"))


@query("gate_by_listing", f"""
SELECT study_id, 'large' AS validation_error, count(*) AS n FROM ({_CUSTOMERS}) WHERE c_acctbal > 9000 GROUP BY 1
""")
def gate_by_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, c = _fresh(spark, "results"), customer_records(spark, sf_dir)
    for vid, what, error in ((VALIDATION_OLD, "c_acctbal < 0", "negative"), (VALIDATION_NEW, "c_acctbal > 9000", "large")):
        writers.append_results(_results(c.filter(what), vid, F.lit(error)), path, run_key=vid)
    return gate.gate_signatures(writers.read_latest_results(spark, path)).select("study_id", "validation_error", "n")


# --- bronze_schema_ledger: batches with differing columns ----------------------------------------


def _batch(df: DataFrame, batch: str, at: str) -> DataFrame:
    return df.withColumns({"row_hash": F.sha2(F.concat_ws("|", *sorted(df.columns)), 256), "_src_batch_id": F.lit(batch), "_src_ingested_at": F.lit(at)})


@query("bronze_schema_ledger", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, NULL AS phone, NULL AS segment, 'a' AS _src_batch_id, 'id,name' AS columns FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), NULL, s_name, NULL, 'b', 'id,phone' FROM supplier
UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, NULL, c_mktsegment, 'c', 'id,name,segment' FROM customer WHERE c_acctbal < 0
""")
def bronze_schema_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, c, s = _fresh(spark, "bronze"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    key = F.col("c_custkey").cast("string").alias("id")
    for batch, df in (("a", c.select(key, F.col("c_name").alias("name"))),
                      ("b", s.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("phone"))),
                      ("c", c.filter("c_acctbal < 0").select(key, F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")))):
        writers.append_bronze(df.withColumn("_src_batch_id", F.lit(batch)), path, run_key=f"run-{batch}")
    told = schema_ledger.columns_per_batch(spark, path).select(F.col("batch_id").alias("__b"), F.array_join("columns", ",").alias("columns"))
    got = writers.read_bronze(spark, path)
    return got.join(told, F.col("_src_batch_id") == F.col("__b")).select("id", "name", "phone", "segment", "_src_batch_id", "columns")


# --- silver_buckets: three batches merged into hash buckets ---------------------------------------


@query("silver_buckets", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'c' WHEN c_acctbal < 0 THEN 'b' ELSE 'a' END AS _src_batch_id
FROM customer
UNION ALL SELECT 's' || s_suppkey, s_name, 'b' FROM supplier
""")
def silver_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, c, s = _fresh(spark, "silver"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")

    def rows(df: DataFrame) -> DataFrame:
        return df.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name")
    more = s.select(F.concat(F.lit("s"), "s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"))
    for batch, at, df in (("a", "2024-01-01", rows(c)), ("c", "2024-03-01", rows(c.filter("c_mktsegment = 'BUILDING'"))),
                          ("b", "2024-02-01", rows(c.filter("c_acctbal < 0")).unionByName(more))):  # b comes late
        for _ in range(2 if batch == "b" else 1):  # and is replayed
            buckets.merge_batch(_batch(df, batch, at), path, run_key=f"run-{batch}", buckets=16)
    return buckets.read_merged(spark, path).select("c_custkey", "c_name", "_src_batch_id")


# --- layer_catalog_dump: a layer's tables from the catalog, dumped and read back typed ---------------


@query("layer_catalog_dump", f"""
SELECT 'customer' AS node, study_id, submitter_id, c_acctbal FROM ({_CUSTOMERS}) WHERE study_id IN ('asia', 'europe') AND c_acctbal > 0
""")
def layer_catalog_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, path, c = f"layer_{uuid.uuid4().hex}", _fresh(spark, "dump"), customer_records(spark, sf_dir)
    spark.sql(f"CREATE DATABASE {db}")
    try:
        for study in ("asia", "europe"):
            for name in (f"silver_{study}_customer", f"silver_{study}_lookup"):
                own = c.filter(F.col("study_id") == study).select("submitter_id", F.col("c_acctbal").cast("double").alias("c_acctbal"))
                own.withColumn("snapshot_id", F.lit(1)).unionByName(own.filter("c_acctbal > 0").withColumn("snapshot_id", F.lit(2))) \
                    .write.partitionBy("snapshot_id").saveAsTable(f"{db}.{name}")
        vid = jobs.dump(spark, tables.list_layer_tables(spark, db), lambda t: spark.table(f"{db}.{t}"), path, validation_id=VALIDATION_NEW)
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
    got = records.read_records(spark, f"{path}/validation", vid)
    schema = {"properties": {"c_acctbal": {"type": "number"}}}
    return records.typed_columns(got, schema).select(F.lit("customer").alias("node"), "study_id", "submitter_id", "c_acctbal")
