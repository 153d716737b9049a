"""Catalogue: the jobs and writers themselves. Every query runs a job or a
sink over testdata into a fresh folder of the shared scratch space and returns
what it reads back
(K1, K3, K4, K5, K6, K8, S5, S9-S11, S13, F5, F6, F9, F12, U3, W4, J6, P12, V1-V10, R2).
"""

from __future__ import annotations

import contextlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import jobs
from strata.operators import checks, landing, release, tables
from strata.plans.common import (BATCH_A, BATCH_B, INGESTED_A, INGESTED_B, SCHEMA_VERSION, VALIDATION_NEW, customer_records,
                                 nation_studies, order_records, query, region_studies, table)
from strata.session import scratch_path
from strata.sinks import writers
from strata.sources.dictionary import dictionary_from_obj, links_frame
from strata.sources.files import read_csv_tolerant
from strata.streaming.landing import promote_batch, read_silver

_STUDY = "lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g'))"
_CUSTOMERS = f"""SELECT c.*, 'customer_' || CAST(c_custkey AS VARCHAR) AS submitter_id, {_STUDY} AS study_id
FROM customer c LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""


def _fresh(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"catalogue/{uuid.uuid4().hex}/{name}")


# --- results_append: runs whose validation id is unknown do not erase each other ----

@query("results_append", f"""
SELECT CAST(NULL AS VARCHAR) AS validation_id, {_STUDY} AS study_id, 'first failure' AS validation_error FROM region
UNION ALL SELECT NULL, {_STUDY}, 'second failure' FROM region
UNION ALL SELECT '{VALIDATION_NEW}', study_id, submitter_id FROM ({_CUSTOMERS}) WHERE c_acctbal < 0
""")
def results_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "results")

    def rows(df: DataFrame, vid: str | None, error) -> DataFrame:
        cols = {c: F.lit(None).cast("string") for c in checks.RESULT_COLUMNS}
        cols |= {"validation_id": F.lit(vid).cast("string"), "index": F.lit(None).cast("bigint"), "study_id": F.col("study_id"),
                 "validation_result": F.lit("ERROR"), "validation_error": error}
        return df.select(*[c.alias(n) for n, c in cols.items()])
    studies = region_studies(spark, sf_dir)
    writers.append_results(rows(studies, None, F.lit("first failure")), path)
    writers.append_results(rows(studies, None, F.lit("second failure")), path)
    negative = rows(customer_records(spark, sf_dir).filter("c_acctbal < 0"), VALIDATION_NEW, F.col("submitter_id"))
    for _ in range(2):  # a retried run replaces its own rows
        writers.append_results(negative, path)
    return writers.read_results(spark, path).select("validation_id", "study_id", "validation_error")


# --- bronze_append: two appends under one marker add up; a retry replaces itself -----

def _deposit(spark: SparkSession, sf_dir: str, batch: str, at: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return landing.bronze_from_table(c, file="submissions/customer.xlsx", sheet="customer", row=F.col("c_custkey") + 3,
                                     study_id="s", batch_id=batch, ingested_at=at)


@query("bronze_append", f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, '{BATCH_A}' AS _src_batch_id FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, '{BATCH_A}' FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, '{BATCH_B}' FROM customer
""")
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "bronze")
    writers.append_bronze(_deposit(spark, sf_dir, BATCH_A, INGESTED_A), path)
    writers.append_bronze(_deposit(spark, sf_dir, BATCH_A, INGESTED_A), path)
    for _ in range(2):
        writers.append_bronze(_deposit(spark, sf_dir, BATCH_B, INGESTED_B), path, run_key="retried")
    return writers.read_bronze(spark, path).select("c_custkey", "c_name", "_src_batch_id")


# --- stream_promotion: append-only silver, newest per hash on read ---------------------

@query("stream_promotion", f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '{BATCH_B}' ELSE '{BATCH_A}' END AS _src_batch_id FROM customer
""")
def stream_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "silver")
    again = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("k"))
    promote_batch(_deposit(spark, sf_dir, BATCH_A, INGESTED_A), path, run_key="epoch-0")
    for _ in range(2):  # the second epoch is replayed
        later = _deposit(spark, sf_dir, BATCH_B, INGESTED_B)
        promote_batch(later.join(again, later.c_custkey == F.col("k"), "left_semi"), path, run_key="epoch-1")
    return read_silver(spark, path).select("c_custkey", "c_name", "_src_batch_id")


# --- import_order_files: each release keeps its own ---------------------------------------

_LINKS = [("orders", "customer"), ("customer", "nation"), ("nation", "region")]


@query("import_order_files", f"""
WITH p AS (SELECT 'v1.0' AS release_dir, {_STUDY} AS study_id FROM region
           UNION ALL SELECT 'v1.1', {_STUDY} FROM region WHERE r_name = 'ASIA')
SELECT release_dir, study_id, unnest(['region', 'nation', 'customer', 'orders']) AS value FROM p
""")
def import_order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "order")
    order = release.import_order(spark, links_frame(spark, _LINKS))
    studies = region_studies(spark, sf_dir).select("study_id")
    for tag, chosen in (("v1.0", studies), ("v1.1", studies.filter("study_id = 'asia'"))):
        writers.write_import_order(order, chosen.withColumn("release_dir", F.lit(tag)), path)
    return spark.read.text(path).select("release_dir", "study_id", "value")


# --- release_export_job -----------------------------------------------------------------------
# One gold model per region, customers with a positive balance from snapshot 2
# on; a model named without a study is reported and the others are exported.

@query("release_export_job", f"""
SELECT 'record' AS kind, 'v2.0' AS release_dir, study_id, 'customer' AS write_table,
       '{{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_name":"' || c_name || '"}}' AS value
FROM ({_CUSTOMERS}) WHERE c_acctbal > 0
UNION ALL SELECT 'finding', 'v2.0', NULL, 'gold', 'no study segment'
""")
def release_export_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "export")
    c = customer_records(spark, sf_dir)
    studies = [r.study_id for r in region_studies(spark, sf_dir).collect()]  # one model a region
    led = spark.createDataFrame(
        [(t, "p_gold_db", f"gold_{s}_customer", n, "sha") for s in studies for t, n in (("1.0", 1), ("2.0", 2))]
        + [("2.0", "p_gold_db", "gold", 2, "sha"), ("2.0", "p_silver_db", "silver_x_y", 2, "sha")],
        "release_tag string, db_name string, model_name string, snapshot_id long, github_sha string")

    def model(db: str, name: str) -> DataFrame:
        own = c.filter(F.col("study_id") == name.split("_")[1]).select("c_custkey", "c_name", "c_acctbal")
        return own.withColumn("snapshot_id", F.lit(1)).unionByName(own.filter("c_acctbal > 0").withColumn("snapshot_id", F.lit(2))) \
            .drop("c_acctbal")
    with contextlib.suppress(writers.PartialFailure):  # raised after everything is written
        jobs.export_release(spark, led, model, path, release.import_order(spark, links_frame(spark, _LINKS)))
    records = spark.read.text(f"{path}/release_jsons").select(
        F.lit("record").alias("kind"), "release_dir", "study_id", "write_table", "value")
    found = spark.read.schema("model_name string, finding string, release_dir string").json(f"{path}/release_findings").select(
        F.lit("finding").alias("kind"), "release_dir", F.lit(None).cast("string").alias("study_id"),
        F.col("model_name").alias("write_table"), F.col("finding").alias("value"))
    return records.unionByName(found)


# --- dump_job: silver at its latest snapshot, and back ---------------------------------------------

@query("dump_job", f"""
SELECT 'customer' AS node, study_id, submitter_id, c_name, c_acctbal FROM ({_CUSTOMERS}) WHERE c_acctbal > 0
""")
def dump_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "dump")
    c = customer_records(spark, sf_dir)
    studies = [r.study_id for r in region_studies(spark, sf_dir).collect()]  # one table a region
    names = [f"silver_{s}_customer" for s in studies] + ["silver_lookup_x", "silver_left_out", "silver_asia_customer_dbt_tmp", "gold_a_b"]

    def read(name: str) -> DataFrame:
        own = c.filter(F.col("study_id") == name.split("_")[1]).select("submitter_id", "c_name", "c_acctbal")
        return own.withColumn("snapshot_id", F.lit(1)).unionByName(own.filter("c_acctbal > 0").withColumn("snapshot_id", F.lit(2)))
    vid = jobs.dump(spark, spark.createDataFrame([(n,) for n in names], "table_name string"), read, path, target="ci",
                    exclude="silver_left_out", validation_id=VALIDATION_NEW)
    records = jobs.read_dump(spark, path, vid, target="ci").records
    return records["customer"].select(F.lit("customer").alias("node"), "study_id", "submitter_id", "c_name",
                                      F.col("c_acctbal").cast("double").alias("c_acctbal"))


# --- dump_bad_lines: a dump's torn lines are ERROR rows, keys of all studies are columns -------------

@query("dump_bad_lines", f"""
SELECT study_id, submitter_id, c_name, CASE WHEN study_id = 'asia' THEN c_mktsegment END AS c_mktsegment, CAST(NULL AS VARCHAR) AS error
FROM ({_CUSTOMERS})
UNION ALL SELECT {_STUDY}, NULL, NULL, NULL, 'is unreadable: not valid JSON' FROM region
""")
def dump_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, null = _fresh(spark, "dump"), F.lit(None).cast("string")
    segment = F.when(F.col("study_id") == "asia", F.col("c_mktsegment"))  # to_json leaves nulls out
    good = customer_records(spark, sf_dir).select("study_id", F.to_json(F.struct("submitter_id", "c_name", segment.alias("c_mktsegment"))).alias("value"))
    torn = region_studies(spark, sf_dir).select("study_id", F.lit('{"submitter_id": "x", "c_na').alias("value"))
    good.unionByName(torn).withColumns({
        "validation_id": F.lit(VALIDATION_NEW), "table_name": F.concat(F.lit("silver_"), F.col("study_id"), F.lit("_customer")),
        "snapshot_id": F.lit("1")}).write.partitionBy("study_id", "validation_id", "table_name", "snapshot_id") \
        .text(f"{path}/{tables.target('ci')['key_prefix']}")
    dump = jobs.read_dump(spark, path, VALIDATION_NEW, target="ci", schema_version=SCHEMA_VERSION)
    records = dump.records["customer"].select("study_id", "submitter_id", "c_name", "c_mktsegment", null.alias("error"))
    lost = dump.bad.select("study_id", "submitter_id", null.alias("c_name"), null.alias("c_mktsegment"),
                           F.regexp_extract("validation_error", "is unreadable.*", 0).alias("error"))
    return records.unionByName(lost)


# --- validate_job: seven nodes, the dictionary's links ------------------------------------------------
# Customers of the BUILDING segment were not deposited, so their orders' link
# is broken; a supplier without a positive balance holds a key too many.

_DICT = {"_version": SCHEMA_VERSION, "region": {"properties": {}},
         "nation": {"properties": {}, "links": [{"name": "regions", "target_type": "region", "required": True}]},
         "customer": {"properties": {"c_mktsegment": {"enum": ["AUTOMOBILE", "HOUSEHOLD", "MACHINERY"]}},
                      "links": [{"name": "nations", "target_type": "nation", "required": True}]},
         "supplier": {"properties": {}, "links": [{"name": "nations", "target_type": "nation"}]},
         "part": {"properties": {"p_size": {"type": ["integer", "null"], "maximum": 49}}},
         "orders": {"properties": {}, "links": [{"name": "customers", "target_type": "customer", "required": True}]},
         "lineitem": {"properties": {}, "links": [{"required": True, "subgroup": [
             {"name": "orders", "target_type": "orders"}, {"name": "parts", "target_type": "part"}]}]}}


def _nodes(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def ident(node: str, *cols: str):
        return F.concat(F.lit(node), *[x for c in cols for x in (F.lit("_"), F.col(c).cast("string"))])
    studies = nation_studies(spark, sf_dir).withColumnRenamed("n_nationkey", "nk")
    t = {n: table(spark, sf_dir, n) for n in ("region", "nation", "supplier", "part", "lineitem")}
    rs = region_studies(spark, sf_dir)
    sid = F.col("study_id")
    return {
        "region": rs.select(ident("region", "r_regionkey").alias("submitter_id"), sid),
        "nation": t["nation"].join(studies, F.col("n_nationkey") == F.col("nk")).select(
            ident("nation", "n_nationkey").alias("submitter_id"), sid, ident("region", "n_regionkey").alias("regions")),
        "customer": customer_records(spark, sf_dir).filter("c_mktsegment <> 'BUILDING'").select(
            "submitter_id", sid, "c_mktsegment", ident("nation", "c_nationkey").alias("nations")),
        "supplier": t["supplier"].join(studies, F.col("s_nationkey") == F.col("nk"), "left").select(
            ident("supplier", "s_suppkey").alias("submitter_id"), sid, ident("nation", "s_nationkey").alias("nations"),
            F.when(F.col("s_acctbal") <= 0, F.col("s_name")).alias("s_owing")),
        "part": t["part"].select(ident("part", "p_partkey").alias("submitter_id"), F.lit("parts").alias("study_id"), "p_size"),
        "orders": order_records(spark, sf_dir).select("submitter_id", sid, ident("customer", "o_custkey").alias("customers")),
        "lineitem": t["lineitem"].select(ident("lineitem", "l_orderkey", "l_linenumber").alias("submitter_id"),
                                         F.lit("lines").alias("study_id"), ident("orders", "l_orderkey").alias("orders"),
                                         ident("part", "l_partkey").alias("parts")),
    }


@query("validate_job", f"""
WITH c AS ({_CUSTOMERS}), o AS (SELECT o.*, c.study_id, c.c_mktsegment FROM orders o LEFT JOIN c ON o_custkey = c_custkey),
s AS (SELECT s.*, {_STUDY} AS study_id FROM supplier s LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
f AS (
  SELECT 'orders' AS node, study_id, 'FAIL' AS validation_result, 'link' AS validator, 'orders_' || CAST(o_orderkey AS VARCHAR) AS submitter_id,
         'link ''customers'' target ''customer_' || CAST(o_custkey AS VARCHAR) || ''' not found' AS validation_error
  FROM o WHERE c_mktsegment IS NULL OR c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT 'customer', study_id, 'FAIL', 'enum', submitter_id,
         '''' || c_mktsegment || ''' is not one of [''AUTOMOBILE'', ''HOUSEHOLD'', ''MACHINERY'']'
  FROM c WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'HOUSEHOLD', 'MACHINERY', 'BUILDING')
  UNION ALL
  SELECT 'supplier', study_id, 'FAIL', 'additionalProperties', 'supplier_' || CAST(s_suppkey AS VARCHAR),
         'Additional properties are not allowed (''s_owing'' was unexpected)' FROM s WHERE s_acctbal <= 0
  UNION ALL
  SELECT 'part', 'parts', 'FAIL', 'maximum', 'part_' || CAST(p_partkey AS VARCHAR),
         CAST(p_size AS VARCHAR) || ' is greater than the maximum of 49' FROM part WHERE p_size > 49
  UNION ALL
  SELECT 'lineitem', 'lines', 'FAIL', 'link', 'lineitem_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR),
         'link ''parts'' target ''part_' || CAST(l_partkey AS VARCHAR) || ''' not found'
  FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)
  UNION ALL
  SELECT 'lineitem', 'lines', 'FAIL', 'link', 'lineitem_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR),
         'link ''orders'' target ''orders_' || CAST(l_orderkey AS VARCHAR) || ''' not found'
  FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
), st AS (SELECT {_STUDY} AS study_id FROM region UNION SELECT 'parts' UNION SELECT 'lines')
SELECT * FROM f
UNION ALL
SELECT NULL, study_id, 'PASS', NULL, NULL, NULL FROM st WHERE study_id NOT IN (SELECT study_id FROM f WHERE study_id IS NOT NULL)
""")
def validate_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "results")
    studies = region_studies(spark, sf_dir).select("study_id").union(
        spark.createDataFrame([("parts",), ("lines",)], "study_id string"))
    with contextlib.suppress(jobs.GateFailed):  # raised after everything is written
        jobs.validate(spark, _nodes(spark, sf_dir), dictionary_from_obj(spark, _DICT), results_path=path, studies=studies,
                      validation_id=VALIDATION_NEW)
    return writers.read_results(spark, path).select("node", "study_id", "validation_result", "validator", "submitter_id",
                                                    "validation_error")


# --- dictionary features over customers, orders and documents --------------------------------------------

_LONG = [str(i) for i in range(1, 251)]


def _findings(spark: SparkSession, df: DataFrame, node: str, spec: dict, **more) -> DataFrame:
    d = dictionary_from_obj(spark, {"_version": "1", node: {"properties": spec}, **more})
    return checks.findings_for_node(df, node, checks.collect_rules(d.rules), validation_id=VALIDATION_NEW, schema_version="1") \
        .select("submitter_id", "invalid_key", "validator", "validator_value")


@query("check_long_enum", f"""
SELECT 'customer_' || CAST(c_custkey AS VARCHAR) AS submitter_id, 'c_custkey' AS invalid_key, 'enum' AS validator,
       '{json.dumps(_LONG, separators=(",", ":"))}' AS validator_value
FROM customer WHERE c_custkey NOT BETWEEN 1 AND 250
""")
def check_long_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _findings(spark, customer_records(spark, sf_dir), "customer", {"c_custkey": {"enum": _LONG}})


@query("check_ref_chain", """
SELECT 'orders_' || CAST(o_orderkey AS VARCHAR) AS submitter_id, 'o_totalprice' AS invalid_key, 'maximum' AS validator,
       '200000' AS validator_value FROM orders WHERE o_totalprice > 200000
""")
def check_ref_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _findings(spark, order_records(spark, sf_dir), "orders", {"o_totalprice": {"$ref": "#/_definitions/price"}},
                     _definitions={"price": {"$ref": "#/_definitions/money", "maximum": 200000},
                                   "money": {"$ref": "#/_definitions/any", "maximum": 9}, "any": {"type": "number"}})


@query("check_type_list", """
SELECT 'documents_' || CAST(doc_id AS VARCHAR) AS submitter_id, 'source' AS invalid_key, 'type' AS validator,
       '["integer","null"]' AS validator_value FROM documents WHERE source IS NOT NULL
""")
def check_type_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.plans.common import document_records
    return _findings(spark, document_records(spark, sf_dir), "documents", {
        "quality": {"type": ["integer", "null"]}, "source": {"type": ["integer", "null"]}, "lang": {"type": ["boolean", "string"]},
        "not_there": {"type": "string"}})


@query("check_format", """
SELECT 'orders_' || CAST(o_orderkey AS VARCHAR) AS submitter_id, 'o_orderpriority' AS invalid_key, 'format' AS validator,
       'date-time' AS validator_value FROM orders
UNION ALL SELECT 'orders_' || CAST(o_orderkey AS VARCHAR), 'o_orderstatus', 'format', 'email' FROM orders
""")
def check_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _findings(spark, order_records(spark, sf_dir), "orders", {
        "o_orderdate": {"format": "date"}, "o_orderpriority": {"format": "date-time"}, "o_orderstatus": {"format": "email"},
        "submitter_id": {"format": "hostname"}})


# --- csv_landing: two header orders, two delimiters, a ragged line ---------------------------------------------

@query("csv_landing", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, NULL AS corrupt FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), NULL FROM supplier
UNION ALL SELECT CAST(r_regionkey AS VARCHAR), r_name, NULL, CAST(r_regionkey AS VARCHAR) || '|' || r_name || '|x' FROM region
""")
def csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "csv")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey") \
        .write.option("header", "true").csv(f"{path}/a")
    table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("c_nationkey"), F.col("s_name").alias("c_name"),
                                            F.col("s_suppkey").alias("c_custkey")) \
        .write.option("header", "true").option("sep", ";").csv(f"{path}/b")
    ragged = table(spark, sf_dir, "region").select(
        F.concat(F.col("r_regionkey").cast("string"), F.lit("|"), F.col("r_name"), F.lit("|x")).alias("line"))
    header = spark.createDataFrame([("c_custkey|c_name",)], "line string")
    header.withColumn("o", F.lit(0)).unionByName(ragged.withColumn("o", F.lit(1))).coalesce(1) \
        .sortWithinPartitions("o").select("line").write.text(f"{path}/c")
    got = read_csv_tolerant(spark, [f"{path}/a", f"{path}/b", f"{path}/c"])
    return got.select("c_custkey", "c_name", "c_nationkey", F.col("_corrupt_record").alias("corrupt"))


# --- csv_multiline: cells with line feeds, delimiters and doubled quotes, over several files ----------------

@query("csv_multiline", """
SELECT 'event_' || event_id AS id, 'line one of ' || event_id || chr(10) || chr(10) || '"quoted", and, commas' || chr(10) || event_type AS note,
       CAST(user_id AS VARCHAR) AS user_id, NULL AS corrupt FROM events WHERE event_id % 3 = 0
UNION ALL SELECT 'event_' || event_id, '5" pipe', CAST(user_id AS VARCHAR), NULL FROM events WHERE event_id % 3 = 1
UNION ALL SELECT 'event_' || event_id, 'id,note,user_id', CAST(user_id AS VARCHAR), NULL FROM events WHERE event_id % 3 = 2
UNION ALL SELECT 'x', '6" pipe', NULL, 'x,6" pipe'
UNION ALL SELECT NULL, NULL, NULL, 'a,"never closed' UNION ALL SELECT NULL, NULL, NULL, 'b,c,d' UNION ALL SELECT 'id', 'note', 'user_id', NULL
""")
def csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, e = _fresh(spark, "csv"), table(spark, sf_dir, "events")
    note = F.when(F.col("event_id") % 3 == 0, F.concat(
        F.lit("line one of "), "event_id", F.lit('\n\n"quoted", and, commas\n'), "event_type")) \
        .when(F.col("event_id") % 3 == 1, F.lit('5" pipe')).otherwise(F.lit("id,note,user_id"))
    e.select(F.concat(F.lit("event_"), "event_id").alias("id"), note.alias("note"), "user_id").repartition(6, "event_id") \
        .write.option("header", "true").option("escape", '"').csv(f"{path}/a")
    spark.createDataFrame([('id,note,user_id\nid,note,user_id\n\nx,6" pipe\na,"never closed\nb,c,d',)], "value string").coalesce(1).write.text(f"{path}/b")
    got = read_csv_tolerant(spark, [f"{path}/a", f"{path}/b"])
    return got.select("id", "note", "user_id", F.col("_corrupt_record").alias("corrupt"))
