"""Catalogue: landing and bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.hashing import uuid5
from strata.functions.naming import safe_names
from strata.operators import audit, landing, promote
from strata.plans.common import (BATCH_A, BATCH_B, INGESTED_A, INGESTED_B, PROVENANCE, query, table)


def _sql_text(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), '')"


def _sql_hash(cols: list[str], file_sql: str, sheet_sql: str, row_sql: str) -> str:
    parts = [f"'{c}=' || {_sql_text(c)}" for c in cols]
    parts += [f"'_src_file=' || {file_sql}", f"'_src_sheet=' || {sheet_sql}", f"'_src_row=' || {row_sql}"]
    return "sha256(concat_ws('|', " + ", ".join(parts) + "))"


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


# --- bronze_row_hash -------------------------------------------------------

@query("bronze_row_hash", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       {_sql_hash(ORDER_COLS, "'deposits/orders.parquet'", "'orders'", "CAST(o_orderkey AS VARCHAR)")} AS row_hash
FROM orders
""")
def bronze_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    b = landing.bronze_from_table(o, file="deposits/orders.parquet", sheet="orders",
                                  row=F.col("o_orderkey"), study_id="tpch", batch_id=BATCH_A,
                                  ingested_at=INGESTED_A, provenance=PROVENANCE)
    return b.select("o_orderkey", "row_hash")


# --- bronze_stamp ------------------------------------------------------------

_CUST_FILE_SQL = "'submissions/nation' || CAST(c_nationkey AS VARCHAR) || '/customer.xlsx'"
_CUST_ROW_SQL = "CAST(c_custkey + 3 AS VARCHAR)"


@query("bronze_stamp", f"""
SELECT {", ".join(f"{_sql_text(c)} AS {c}" for c in CUSTOMER_COLS)},
       {_CUST_FILE_SQL} AS _src_file,
       'customer' AS _src_sheet,
       {_CUST_ROW_SQL} AS _src_row,
       'nation' || CAST(c_nationkey AS VARCHAR) AS _src_study_id,
       '0.4.2' AS _src_g3mt_version,
       'dictionary.json' AS _src_schema_file,
       '' AS _src_target_node,
       '{BATCH_A}' AS _src_batch_id,
       '{INGESTED_A}' AS _src_ingested_at,
       {_sql_hash(CUSTOMER_COLS, _CUST_FILE_SQL, "'customer'", _CUST_ROW_SQL)} AS row_hash
FROM customer
""")
def bronze_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return landing.bronze_from_table(
        c,
        file=F.concat(F.lit("submissions/nation"), F.col("c_nationkey"), F.lit("/customer.xlsx")),
        sheet="customer",
        row=F.col("c_custkey") + 3,
        study_id=F.concat(F.lit("nation"), F.col("c_nationkey").cast("string")),
        batch_id=BATCH_A, ingested_at=INGESTED_A, provenance=PROVENANCE)


# --- safe_names ----------------------------------------------------------------
# Headers are the parts of each page's URL (split on / ? & # . = :), blank
# parts dropped (F2); the fold numbers collisions per page.

URL_SPLIT = r"[/?&#.=:]"


@query("safe_names", r"""
WITH RECURSIVE h AS (
  SELECT page_id, list_filter(regexp_split_to_array(url, '[/?&#.=:]'), lambda x: x <> '') AS hs FROM pages
), walk(page_id, pos, hs, taken) AS (
  SELECT page_id, 0, hs, CAST([] AS VARCHAR[]) FROM h
  UNION ALL
  SELECT page_id, pos + 1, hs,
         list_append(taken, (
           SELECT CASE WHEN n = 1 THEN b ELSE b || '_' || CAST(n AS VARCHAR) END
           FROM (SELECT regexp_replace(lower(hs[pos + 1]), '[^a-z0-9_]', '_', 'g') AS b) bb,
                range(1, len(taken) + 2) t(n)
           WHERE NOT list_contains(taken, CASE WHEN n = 1 THEN b ELSE b || '_' || CAST(n AS VARCHAR) END)
           ORDER BY n LIMIT 1))
  FROM walk WHERE pos < len(hs)
)
SELECT page_id, CAST(i AS BIGINT) AS pos, hs[i] AS header, taken[i] AS safe_name
FROM (SELECT page_id, hs, taken, generate_subscripts(hs, 1) AS i FROM walk WHERE pos = len(hs))
""")
def safe_names_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select(
        "page_id", F.filter(F.split("url", URL_SPLIT, -1), lambda x: x != "").alias("hs"))
    named = p.select("page_id", F.arrays_zip(F.col("hs").alias("header"),
                                             safe_names("hs").alias("safe_name")).alias("z"))
    return named.select("page_id", F.posexplode("z").alias("pos", "s")).select(
        "page_id", (F.col("pos") + 1).cast("bigint").alias("pos"),
        F.col("s.header").alias("header"), F.col("s.safe_name").alias("safe_name"))


# --- dedupe_bronze ---------------------------------------------------------------
# Batch A deposits all of lineitem; batch B re-deposits the returned lines
# (same hashes, newer ingest time). W1 keeps the newest copy per hash.

_LI_FILE = "'deposits/lineitem.parquet'"
_LI_ROW = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"


@query("dedupe_bronze", f"""
WITH a AS (
  SELECT *, '{BATCH_A}' AS b, '{INGESTED_A}' AS t FROM lineitem
  UNION ALL
  SELECT *, '{BATCH_B}' AS b, '{INGESTED_B}' AS t FROM lineitem WHERE l_returnflag = 'R'
), h AS (
  SELECT *, {_sql_hash(LINEITEM_COLS, _LI_FILE, "'lineitem'", _LI_ROW)} AS row_hash FROM a
)
SELECT row_hash, b AS _src_batch_id, t AS _src_ingested_at,
       CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber
FROM h
QUALIFY row_number() OVER (PARTITION BY row_hash ORDER BY t DESC, b DESC) = 1
""")
def dedupe_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    row = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))

    def deposit(df, batch, at):
        return landing.bronze_from_table(df, file="deposits/lineitem.parquet", sheet="lineitem", row=row,
                                         study_id="tpch", batch_id=batch, ingested_at=at,
                                         provenance=PROVENANCE)
    bronze = deposit(li, BATCH_A, INGESTED_A).unionByName(
        deposit(li.filter(F.col("l_returnflag") == "R"), BATCH_B, INGESTED_B))
    return promote.dedupe_bronze(bronze).select("row_hash", "_src_batch_id", "_src_ingested_at",
                                                "l_orderkey", "l_linenumber")


# --- dedupe_in_run -----------------------------------------------------------------
# Documents land per source as one deposit without row coordinates, so a text
# repeated within a source is the same bronze row; W3 keeps one.

@query("dedupe_in_run", """
SELECT DISTINCT
  sha256(concat_ws('|', 'text=' || coalesce(text, ''), '_src_file=deposits/documents/' || source,
                   '_src_sheet=documents', '_src_row=')) AS row_hash,
  'deposits/documents/' || source AS _src_file,
  CAST(length(text) AS BIGINT) AS text_chars
FROM documents
""")
def dedupe_in_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    b = landing.bronze_from_table(d.select("text", "source"), data_columns=["text"],
                                  file=F.concat(F.lit("deposits/documents/"), F.col("source")),
                                  sheet="documents", row="", study_id=F.col("source"),
                                  batch_id=BATCH_A, ingested_at=INGESTED_A, provenance=PROVENANCE)
    return landing.dedupe_in_run(b).select("row_hash", "_src_file",
                                           F.length("text").cast("bigint").alias("text_chars"))


# --- dedupe_registry -------------------------------------------------------------------
# Events stand in for file registrations: the file is (user_id, event_type),
# each event a revision; the newest per file survives.

@query("dedupe_registry", """
SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS registered_at
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def dedupe_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    newest = promote.dedupe_registry(e, ["user_id", "event_type"], "ts", tiebreak=("event_id",))
    return newest.select("user_id", "event_type", "event_id",
                         F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("registered_at"))


# --- registry_baseid -----------------------------------------------------------------------

@query("registry_baseid", """
WITH f AS (
  SELECT doc_id, source || '/doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS file_name FROM documents
), h AS (
  SELECT doc_id, file_name, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(file_name)) AS d FROM f
)
SELECT doc_id, file_name,
       substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' ||
       substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(d, 17, 1)), 1) || substr(d, 18, 3) || '-' ||
       substr(d, 21, 12) AS baseid
FROM h
""")
def registry_baseid(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    f = d.select("doc_id", F.concat(F.col("source"), F.lit("/doc_"), F.col("doc_id"), F.lit(".txt")).alias("file_name"))
    return f.select("doc_id", "file_name", uuid5("file_name").alias("baseid"))


# --- duplicate_ratio ---------------------------------------------------------------------------

@query("duplicate_ratio", """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_keys,
       CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_repeated_keys,
       CAST(round(CAST(sum(n) AS DOUBLE) / count(*), 4) AS DECIMAL(12,4)) AS dup_ratio
FROM k
""")
def duplicate_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_ratio(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- batch_inventory ------------------------------------------------------------------------------
# Each day of events is one landing batch.

@query("batch_inventory", """
SELECT 'batch-' || strftime(ts, '%Y%m%d') AS _src_batch_id, CAST(count(*) AS BIGINT) AS n_rows,
       strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at
FROM events GROUP BY 1
""")
def batch_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(
        F.concat(F.lit("batch-"), F.date_format("ts", "yyyyMMdd")).alias("_src_batch_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_src_ingested_at"))
    return audit.batch_inventory(e)


# --- union_evolving --------------------------------------------------------------------------------

@query("union_evolving", """
SELECT * FROM (
  SELECT 'customer_' || CAST(c_custkey AS VARCHAR) AS submitter_id, c_name AS name,
         CAST(c_nationkey AS BIGINT) AS nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS acctbal,
         c_mktsegment AS mktsegment
  FROM customer)
UNION ALL BY NAME
SELECT * FROM (
  SELECT 'supplier_' || CAST(s_suppkey AS VARCHAR) AS submitter_id, s_name AS name,
         CAST(s_nationkey AS BIGINT) AS nationkey, CAST(s_acctbal AS DECIMAL(12,2)) AS acctbal
  FROM supplier)
""")
def union_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("customer_"), F.col("c_custkey")).alias("submitter_id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("nationkey"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"))
    s = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("supplier_"), F.col("s_suppkey")).alias("submitter_id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("bigint").alias("nationkey"),
        F.col("s_acctbal").cast("decimal(12,2)").alias("acctbal"))
    return landing.stack([c, s])


# --- header_inventory ---------------------------------------------------------------------------------
# Each event type is a node; the keys of its ``props`` are its headers. The
# node's required headers are ``k`` and ``source``.

@query("header_inventory", """
WITH k AS (SELECT DISTINCT event_type, unnest(json_keys(props)) AS key FROM events),
g AS (SELECT event_type, list_sort(list(key)) AS keys FROM k GROUP BY event_type)
SELECT event_type AS node, array_to_string(keys, ',') AS headers, CAST(len(keys) AS BIGINT) AS n_headers,
       array_to_string(list_sort(list_filter(['k', 'source'], lambda x: NOT list_contains(keys, x))), ',')
         AS missing_required
FROM g
""")
def header_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    keys = e.select("event_type", F.explode(F.json_object_keys("props")).alias("key")).distinct()
    g = keys.groupBy("event_type").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    return g.select(F.col("event_type").alias("node"), F.array_join("keys", ",").alias("headers"),
                    F.size("keys").cast("bigint").alias("n_headers"),
                    F.array_join(landing.missing_required(F.col("keys"), ["k", "source"]), ",")
                    .alias("missing_required"))

