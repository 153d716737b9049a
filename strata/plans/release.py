"""Catalogue: releases, pins, import order and audits
(T1, T2, T5, T6, T7, F7, F13, J8, J9, J10, J11, K4, K8, P11, S11, A8, X16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import release_path
from strata.functions.text import PY_STRIP_PATTERN
from strata.operators import audit, release
from strata.sinks.writers import KEEP_NULLS
from strata.plans.common import TESTDATA_LINKS, customer_records, node_keys, order_records, query, table
from strata.plans.validation import testdata_dictionary

# --- tags -----------------------------------------------------------------------
# Release tags built from order dates: ``<year-1990>.<month>.<day>``, urgent
# orders as release candidates (``rc1``), pending orders ``v``-prefixed.

_TAGS_SQL = """
SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN 'v' ELSE '' END ||
       CAST(year(o_orderdate) - 1990 AS VARCHAR) || '.' || CAST(month(o_orderdate) AS VARCHAR) || '.' ||
       CAST(day(o_orderdate) AS VARCHAR) || CASE WHEN o_orderpriority = '1-URGENT' THEN 'rc1' ELSE '' END
       AS release_tag
FROM orders
"""
_VERSION_SQL = (f"list_transform(string_split(regexp_replace(release_tag, '{PY_STRIP_PATTERN}', '', 'g'), '.'), "
                "lambda x: coalesce(TRY_CAST(nullif(regexp_extract(x, '^([0-9]+)', 1), '') AS DECIMAL(38,0)), 0))")


def release_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    tag = F.concat(F.when(F.col("o_orderstatus") == "P", "v").otherwise(""),
                   (F.year("o_orderdate") - 1990).cast("string"), F.lit("."),
                   F.month("o_orderdate").cast("string"), F.lit("."), F.dayofmonth("o_orderdate").cast("string"),
                   F.when(F.col("o_orderpriority") == "1-URGENT", "rc1").otherwise(""))
    return o.select(tag.alias("release_tag")).distinct()


@query("latest_release", f"""
SELECT release_tag FROM ({_TAGS_SQL}) ORDER BY {_VERSION_SQL} DESC, length(release_tag), release_tag LIMIT 1
""")
def latest_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.latest_release(release_tags(spark, sf_dir))


@query("previous_release", f"""
SELECT release_tag FROM ({_TAGS_SQL}) ORDER BY {_VERSION_SQL} DESC, length(release_tag), release_tag
LIMIT 1 OFFSET 1
""")
def previous_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.previous_release(release_tags(spark, sf_dir))


# --- import order / upload plan --------------------------------------------------------

_EDGES_SQL = "VALUES " + ", ".join(f"('{c}', '{p}')" for c, p in TESTDATA_LINKS)
_NODE_KEYS_SQL = """
SELECT 'region' AS node, 'region_' || CAST(r_regionkey AS VARCHAR) AS submitter_id FROM region
UNION ALL SELECT 'nation', 'nation_' || CAST(n_nationkey AS VARCHAR) FROM nation
UNION ALL SELECT 'customer', 'customer_' || CAST(c_custkey AS VARCHAR) FROM customer
UNION ALL SELECT 'supplier', 'supplier_' || CAST(s_suppkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'part', 'part_' || CAST(p_partkey AS VARCHAR) FROM part
UNION ALL SELECT 'orders', 'orders_' || CAST(o_orderkey AS VARCHAR) FROM orders
UNION ALL SELECT 'lineitem', 'lineitem_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR)
  FROM lineitem
"""
_ORDER_SQL = f"""
WITH RECURSIVE e(child, parent) AS ({_EDGES_SQL}),
n AS (SELECT parent AS node FROM e UNION SELECT child FROM e),
walk(node, depth, path) AS (
  SELECT node, 0, [node] FROM n WHERE node NOT IN (SELECT child FROM e WHERE parent <> child)
  UNION ALL
  SELECT e.child, w.depth + 1, list_append(w.path, e.child)
  FROM walk w JOIN e ON e.parent = w.node WHERE NOT list_contains(w.path, e.child)
),
lv AS (SELECT node, max(depth) AS level FROM walk GROUP BY node)
SELECT n.node, CAST(lv.level AS BIGINT) AS level,
       CAST(row_number() OVER (ORDER BY lv.level NULLS LAST, n.node) - 1 AS BIGINT) AS pos,
       lv.level IS NULL AS cycle
FROM n LEFT JOIN lv ON n.node = lv.node
"""


def testdata_order(spark: SparkSession) -> DataFrame:
    """The import order of the testdata dictionary, from its links."""
    return release.import_order(spark, testdata_dictionary(spark).links)


@query("import_order", f"""
WITH o AS ({_ORDER_SQL}),
cnt AS (SELECT node, CAST(count(*) AS BIGINT) AS n_records FROM ({_NODE_KEYS_SQL}) GROUP BY node)
SELECT o.node, o.level, o.pos, o.cycle, cnt.n_records FROM o LEFT JOIN cnt ON o.node = cnt.node
""")
def import_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = audit.row_counts(node_keys(spark, sf_dir), ["node"]).withColumnRenamed("n_rows", "n_records")
    return testdata_order(spark).join(counts, "node", "left")


@query("upload_plan", f"""
WITH o AS ({_ORDER_SQL})
SELECT k.node, k.submitter_id, o.level, o.pos FROM ({_NODE_KEYS_SQL}) k JOIN o ON k.node = o.node
ORDER BY o.pos, k.submitter_id
""")
def upload_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.upload_plan(node_keys(spark, sf_dir), testdata_order(spark))


# --- ledger --------------------------------------------------------------------------------
# Parts are gold models (one per part). The ledger already holds release
# 1.0.0 for every part and 1.1.0 for the SMALL parts (an earlier, partial
# push); the push writes 1.1.0 for every part to the real and the CI gold
# database. Only the missing real rows are appended.

_MODEL_SQL = ("'gold_' || lower(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) || '_part' || "
              "CAST(p_partkey AS VARCHAR)")
_LEDGER_SQL = f"""
SELECT '1.0.0' AS release_tag, 'proj_gold_db' AS db_name, {_MODEL_SQL} AS model_name,
       CAST(1000 + p_partkey AS BIGINT) AS snapshot_id, 'abc123' AS github_sha FROM part
UNION ALL
SELECT '1.1.0', 'proj_gold_db', {_MODEL_SQL}, CAST(1000 + p_partkey AS BIGINT), 'abc123' FROM part
WHERE p_type = 'SMALL'
"""
_PUSH_SQL = f"""
SELECT '1.1.0' AS release_tag, 'proj_gold_db' AS db_name, {_MODEL_SQL} AS model_name,
       CAST(2000 + p_partkey AS BIGINT) AS snapshot_id, 'def456' AS github_sha FROM part
UNION ALL
SELECT '1.1.0', 'ci_proj_gold_db', {_MODEL_SQL}, CAST(2000 + p_partkey AS BIGINT), 'def456' FROM part
"""


def _model_name():
    return F.concat(F.lit("gold_"), F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")), F.lit("_part"),
                    F.col("p_partkey"))


@query("ledger_idempotent", f"""
WITH l AS ({_LEDGER_SQL}), p AS ({_PUSH_SQL})
SELECT * FROM p
WHERE NOT starts_with(db_name, 'ci_')
  AND NOT EXISTS (SELECT 1 FROM l WHERE l.release_tag = p.release_tag AND l.db_name = p.db_name
                  AND l.model_name = p.model_name)
""")
def ledger_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")

    def rows(parts, tag, db, base, sha):
        return parts.select(F.lit(tag).alias("release_tag"), F.lit(db).alias("db_name"),
                            _model_name().alias("model_name"),
                            (F.col("p_partkey") + base).cast("bigint").alias("snapshot_id"),
                            F.lit(sha).alias("github_sha"))
    existing = rows(p, "1.0.0", "proj_gold_db", 1000, "abc123").unionByName(
        rows(p.filter(F.col("p_type") == "SMALL"), "1.1.0", "proj_gold_db", 1000, "abc123"))
    push = rows(p, "1.1.0", "proj_gold_db", 2000, "def456").unionByName(
        rows(p, "1.1.0", "ci_proj_gold_db", 2000, "def456"))
    return release.append_ledger_rows(existing, push)


# --- read_pinned ----------------------------------------------------------------------------------
# Orders are committed once per order year (snapshot id = year, append-only).
# The ledger pins each study's gold orders model per release; the latest
# release's gold rows drive a cumulative read (all commits up to the pin).

_PIN_LEDGER_SQL = """
SELECT '1.0.0' AS release_tag, 'proj_gold_db' AS db_name,
       'gold_' || lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g')) || '_orders' AS model_name,
       CAST(1997 AS BIGINT) AS snapshot_id FROM region
UNION ALL
SELECT '1.1.0', 'proj_gold_db', 'gold_' || lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g')) || '_orders',
       CAST(1996 + r_regionkey AS BIGINT) FROM region
UNION ALL
SELECT '1.1.0', 'proj_silver_db', 'silver_' || lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g')) || '_orders',
       CAST(2001 AS BIGINT) FROM region
"""


def pin_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    study = F.lower(F.regexp_replace("r_name", "[^A-Za-z]", ""))

    def rows(tag, db, layer, snap):
        return r.select(F.lit(tag).alias("release_tag"), F.lit(db).alias("db_name"),
                        F.concat(F.lit(layer + "_"), study, F.lit("_orders")).alias("model_name"),
                        snap.cast("bigint").alias("snapshot_id"))
    return (rows("1.0.0", "proj_gold_db", "gold", F.lit(1997))
            .unionByName(rows("1.1.0", "proj_gold_db", "gold", F.col("r_regionkey") + 1996))
            .unionByName(rows("1.1.0", "proj_silver_db", "silver", F.lit(2001))))


@query("read_pinned", f"""
WITH l AS ({_PIN_LEDGER_SQL}),
tag AS (SELECT release_tag FROM (SELECT DISTINCT release_tag FROM l)
        ORDER BY {_VERSION_SQL} DESC, length(release_tag), release_tag LIMIT 1),
pins AS (SELECT l.release_tag, string_split(model_name, '_')[2] AS study_id, snapshot_id AS pin FROM l
         WHERE release_tag = (SELECT release_tag FROM tag) AND db_name LIKE '%gold%'),
o AS (
  SELECT o_orderkey, s.study_id, CAST(year(o_orderdate) AS BIGINT) AS snapshot_id
  FROM orders LEFT JOIN (
    SELECT c_custkey, lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g')) AS study_id
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) s
  ON o_custkey = s.c_custkey)
SELECT o.o_orderkey, o.study_id, o.snapshot_id, pins.pin, pins.release_tag
FROM o JOIN pins ON o.study_id = pins.study_id AND o.snapshot_id <= pins.pin
""")
def read_pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = pin_ledger(spark, sf_dir)
    models = release.export_models(release.release_rows(ledger, release.latest_release(ledger)))
    pins = models.select("study_id", "snapshot_id", "release_tag")
    o = order_records(spark, sf_dir).select(
        "o_orderkey", "study_id", F.substring("o_orderdate", 1, 4).cast("bigint").alias("snapshot_id"))
    pinned = release.read_pinned(o, pins, keys=("study_id",), cumulative=True)
    return pinned.select("o_orderkey", "study_id", "snapshot_id", F.col("__pin").alias("pin"), "release_tag")


# --- delete_plan ---------------------------------------------------------------------------------
# Orders as upload-audit rows; the plan for project ``proj``, version
# ``v2.0`` (normalised), children first.

_AUDIT_SQL = """
SELECT 'proj' AS project_id,
       CASE WHEN o_orderstatus = 'O' THEN '1.0' WHEN o_orderpriority = '1-URGENT' THEN 'v2.0' ELSE '2.0' END AS version,
       'https://data.example.org' AS api_endpoint,
       CASE o_orderstatus WHEN 'F' THEN 'lineitem' WHEN 'P' THEN 'orders' ELSE 'customer' END AS node,
       'dg.' || CAST(o_orderkey AS VARCHAR) AS gen3_guid
FROM orders
"""


@query("delete_plan", f"""
WITH a AS ({_AUDIT_SQL}), o AS ({_ORDER_SQL})
SELECT a.gen3_guid, a.node, o.level, o.pos
FROM a JOIN o ON a.node = o.node
WHERE a.project_id = 'proj' AND regexp_replace(a.version, '^[vV]', '') = '2.0'
  AND a.api_endpoint = 'https://data.example.org'
ORDER BY o.pos DESC, a.gen3_guid
""")
def delete_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    a = o.select(
        F.lit("proj").alias("project_id"),
        F.when(F.col("o_orderstatus") == "O", "1.0").when(F.col("o_orderpriority") == "1-URGENT", "v2.0")
        .otherwise("2.0").alias("version"),
        F.lit("https://data.example.org").alias("api_endpoint"),
        F.when(F.col("o_orderstatus") == "F", "lineitem").when(F.col("o_orderstatus") == "P", "orders")
        .otherwise("customer").alias("node"),
        F.concat(F.lit("dg."), F.col("o_orderkey")).alias("gen3_guid"))
    chosen = release.select_audit(a, "proj", "v2.0", "https://data.example.org")
    return release.delete_plan(chosen, testdata_order(spark)).select("gen3_guid", "node", "level", "pos")


# --- outcome_tally -------------------------------------------------------------------------------
# Each (event type, day) is a unit of a run; error units failed.

@query("outcome_tally", """
WITH u AS (
  SELECT DISTINCT event_type || '/' || strftime(ts, '%Y-%m-%d') AS unit,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status
  FROM events
)
SELECT status, CAST(count(*) AS BIGINT) AS n_units, string_agg(CASE WHEN status = 'failed' THEN unit END, ',' ORDER BY unit) AS names FROM u GROUP BY status
""")
def outcome_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    units = e.select(F.concat_ws("/", "event_type", F.date_format("ts", "yyyy-MM-dd")).alias("unit"),
                     F.when(F.col("event_type") == "error", "failed").otherwise("succeeded").alias("status")).distinct()
    return audit.outcome_tally(units)


# --- download_status --------------------------------------------------------------------------------
# Each event's ``k`` is read as a download-probe status; small ``k`` means the
# record has no URL.

@query("download_status", """
WITH s AS (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), t AS (
  SELECT event_id, k, CASE WHEN k < 60 THEN 200 WHEN k < 75 THEN 404 WHEN k < 90 THEN 401 ELSE 500 END AS status FROM s
)
SELECT event_id, CAST(status AS BIGINT) AS status,
       CASE WHEN k < 5 THEN 'no location' WHEN status = 404 THEN 'not registered'
            WHEN status = 401 THEN 'authorisation gap' WHEN status = 500 THEN 'service fault'
            WHEN status >= 200 AND status < 300 THEN 'ok' ELSE 'unexpected status' END AS meaning
FROM t
""")
def download_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    status = F.when(F.col("k") < 60, 200).when(F.col("k") < 75, 404).when(F.col("k") < 90, 401).otherwise(500)
    urls = F.when(F.col("k") < 5, F.array().cast("array<string>")) \
        .otherwise(F.array(F.concat(F.lit("s3://objects/"), F.col("event_id").cast("string"))))
    s = e.select("event_id", status.cast("bigint").alias("status"), urls.alias("urls"))
    return s.select("event_id", "status", audit.download_meaning(F.col("status"), F.col("urls")).alias("meaning"))


# --- release_export -----------------------------------------------------------------------------------
# Gold customer models per study; the latest release's rows are exported as
# ``release_jsons/v<tag>/<study>/<table>.json`` records.

_EXPORT_LEDGER_SQL = """
SELECT '1.2' AS release_tag, 'proj_gold_db' AS db_name,
       'gold_' || lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g')) || '_customer' AS model_name FROM region
UNION ALL
SELECT '1.10.0', 'proj_gold_db', 'gold_' || lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g')) || '_customer'
FROM region WHERE r_regionkey <> 2
"""


def export_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    model = F.concat(F.lit("gold_"), F.lower(F.regexp_replace("r_name", "[^A-Za-z]", "")), F.lit("_customer"))
    return (r.select(F.lit("1.2").alias("release_tag"), F.lit("proj_gold_db").alias("db_name"), model.alias("model_name"))
            .unionByName(r.filter("r_regionkey <> 2").select(F.lit("1.10.0").alias("release_tag"),
                                                            F.lit("proj_gold_db").alias("db_name"),
                                                            model.alias("model_name")))
            .withColumn("snapshot_id", F.lit(1).cast("bigint")))


@query("release_export", f"""
WITH l AS ({_EXPORT_LEDGER_SQL}),
tag AS (SELECT release_tag FROM (SELECT DISTINCT release_tag FROM l)
        ORDER BY {_VERSION_SQL} DESC, length(release_tag), release_tag LIMIT 1),
m AS (SELECT release_tag, string_split(model_name, '_')[2] AS study_id, string_split(model_name, '_')[3] AS write_table
      FROM l WHERE release_tag = (SELECT release_tag FROM tag) AND db_name LIKE '%gold%'),
c AS (SELECT 'customer_' || CAST(c_custkey AS VARCHAR) AS submitter_id,
             lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g')) AS study_id, c_name, c_mktsegment, c_acctbal
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT 'release_jsons/v' || m.release_tag || '/' || m.study_id || '/' || m.write_table || '.json' AS path,
       to_json({{'submitter_id': c.submitter_id, 'c_name': c.c_name, 'c_mktsegment': c.c_mktsegment,
                'c_acctbal': c.c_acctbal}})::VARCHAR AS record
FROM c JOIN m ON c.study_id = m.study_id
""")
def release_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = export_ledger(spark, sf_dir)
    models = release.export_models(release.release_rows(ledger, release.latest_release(ledger)))
    c = customer_records(spark, sf_dir)
    j = c.join(models.select("study_id", "write_table", "release_tag"), "study_id")
    return j.select(release_path("release_tag", "study_id", "write_table").alias("path"),
                    F.to_json(F.struct("submitter_id", "c_name", "c_mktsegment", "c_acctbal"), KEEP_NULLS).alias("record"))
