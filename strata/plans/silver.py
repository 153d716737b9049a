"""Catalogue: naming conventions and silver promotion
(P5, P6, P7, P8, P9, P10, F1, F2, F3, F5, F6, F10, U3, J1, J2, J3, J4, V9, X1, X14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import is_workbook, parse_model_name, study_from_path, study_from_table
from strata.functions.text import PY_STRIP_PATTERN, py_strip
from strata.operators import promote, tables
from strata.sinks.writers import KEEP_NULLS
from strata.plans.common import TESTDATA_LINKS, query, table

# --- study_from_path -----------------------------------------------------------
# Each page URL's path is an object key under ``submissions``; URLs with a
# query string end in ``.XLSX``, with a fragment in ``.csv`` (not a workbook),
# otherwise ``.xlsx``. Trailing-slash paths give a lock file ``~$index.xlsx``.

_PATH_RE = r"^[A-Za-z]+://[^/]+(/[^?#]*)"


@query("study_from_path", r"""
WITH k AS (
  SELECT page_id,
         'submissions' || CASE WHEN ends_with(p, '/') THEN p || '~$index' ELSE p END ||
         CASE WHEN url LIKE '%?%' THEN '.XLSX' WHEN url LIKE '%#%' THEN '.csv' ELSE '.xlsx' END AS object_key
  FROM (SELECT page_id, url, regexp_extract(url, '^[A-Za-z]+://[^/]+(/[^?#]*)', 1) AS p FROM pages)
), f AS (
  SELECT page_id, object_key, list_filter(string_split(substr(object_key, 12), '/'), lambda x: x <> '') AS parts,
         string_split(object_key, '/')[-1] AS name
  FROM k
)
SELECT page_id, object_key, CASE WHEN len(parts) > 1 THEN parts[1] ELSE 'unassigned' END AS study_id
FROM f
WHERE lower(name) LIKE '%.xlsx' AND NOT starts_with(name, '~$')
""")
def study_from_path_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url",
                                             F.regexp_extract("url", _PATH_RE, 1).alias("p"))
    path = F.when(F.col("p").endswith("/"), F.concat("p", F.lit("~$index"))).otherwise(F.col("p"))
    ext = F.when(F.col("url").contains("?"), ".XLSX").when(F.col("url").contains("#"), ".csv").otherwise(".xlsx")
    keys = p.select("page_id", F.concat(F.lit("submissions"), path, ext).alias("object_key"))
    return keys.filter(is_workbook("object_key")).select("page_id", "object_key",
                                                         study_from_path("object_key").alias("study_id"))


# --- parse_model_name ---------------------------------------------------------------
# Model names built from parts (brand = study, name = table; ECONOMY parts
# are staging models, SMALL parts prod models) and from nations (names with
# an underscore inside the study, and names without any underscore).

_PART_MODEL_SQL = """
  SELECT DISTINCT 'gold_' || CASE p_type WHEN 'ECONOMY' THEN 'staging_' WHEN 'SMALL' THEN 'prod_' ELSE '' END
         || lower(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) || '_' || replace(p_name, ' ', '_') AS model_name
  FROM part
  UNION
  SELECT CASE WHEN n_regionkey = 0 THEN 'gold' || CAST(n_nationkey AS VARCHAR)
              WHEN n_regionkey = 1 THEN 'gold_staging_' || lower(n_name)
              ELSE 'silver_' || lower(n_name) END FROM nation
"""


def _model_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    env = F.when(F.col("p_type") == "ECONOMY", "staging_").when(F.col("p_type") == "SMALL", "prod_").otherwise("")
    parts = p.select(F.concat(F.lit("gold_"), env, F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")),
                              F.lit("_"), F.regexp_replace("p_name", " ", "_")).alias("model_name"))
    n = table(spark, sf_dir, "nation")
    nations = n.select(F.when(F.col("n_regionkey") == 0, F.concat(F.lit("gold"), F.col("n_nationkey")))
                       .when(F.col("n_regionkey") == 1, F.concat(F.lit("gold_staging_"), F.lower("n_name")))
                       .otherwise(F.concat(F.lit("silver_"), F.lower("n_name"))).alias("model_name"))
    return parts.union(nations).distinct()


@query("parse_model_name", f"""
WITH m AS ({_PART_MODEL_SQL}),
s AS (SELECT model_name, string_split(model_name, '_') AS parts FROM m),
e AS (SELECT *, len(parts) AS n, parts[2] IN ('staging', 'prod') AS env FROM s)
SELECT model_name,
       CASE WHEN n < 2 THEN NULL WHEN env AND n < 3 THEN NULL
            WHEN env THEN parts[2] || '/' || parts[3] ELSE parts[2] END AS study_id,
       CASE WHEN env AND n >= 4 THEN array_to_string(parts[4:], '_')
            WHEN NOT env AND n >= 3 THEN array_to_string(parts[3:], '_') ELSE '' END AS write_table,
       CASE WHEN n >= 2 THEN parts[2] END AS study_plain,
       CASE WHEN n < 2 THEN 'no study segment'
            WHEN env AND n < 3 THEN 'no study after environment segment'
            WHEN (env AND n < 4) OR (NOT env AND n < 3) THEN 'empty table part' END AS finding
FROM e
""")
def parse_model_name_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _model_names(spark, sf_dir).withColumn("p", parse_model_name("model_name"))
    return m.select("model_name", F.col("p.study_id").alias("study_id"), F.col("p.write_table").alias("write_table"),
                    study_from_table("model_name").alias("study_plain"), F.col("p.finding").alias("finding"))


# --- export_candidates ------------------------------------------------------------------
# Silver table names built from parts, with the suffixes and infixes the
# exporter must skip, and an exclude list given as a comma string.

EXCLUDE_TABLES = " silver_brand1_red_widget, ,silver_brand2_small_ring,"


@query("export_candidates", """
WITH base AS (
  SELECT lower(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) AS b, replace(p_name, ' ', '_') AS n, p_type FROM part
), names AS (
  SELECT 'silver_' || b || '_' || n AS table_name FROM base
  UNION ALL SELECT 'silver_' || b || '_' || n || '_dbt_tmp' FROM base WHERE p_type = 'ECONOMY'
  UNION ALL SELECT 'silver_' || b || '_lookup_' || n FROM base WHERE p_type = 'SMALL'
  UNION ALL SELECT 'silver_' || b || '_' || n || '_rm_null' FROM base WHERE p_type = 'LARGE'
  UNION ALL SELECT 'silver_' || b || '_latest_ingest' FROM base WHERE p_type = 'PROMO'
  UNION ALL SELECT 'bronze_' || b || '_' || n FROM base WHERE p_type = 'MEDIUM'
), excl AS (
  SELECT trim(x) AS t FROM (SELECT unnest(string_split(' silver_brand1_red_widget, ,silver_brand2_small_ring,', ',')) AS x)
  WHERE trim(x) <> ''
)
SELECT DISTINCT table_name, string_split(table_name, '_')[2] AS study_id
FROM names
WHERE starts_with(table_name, 'silver') AND NOT ends_with(table_name, '_dbt_tmp')
  AND table_name NOT LIKE '%lookup%' AND table_name NOT LIKE '%\\_rm\\_null%' ESCAPE '\\'
  AND table_name NOT LIKE '%latest\\_ingest%' ESCAPE '\\'
  AND table_name NOT IN (SELECT t FROM excl)
""")
def export_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(
        F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")).alias("b"),
        F.regexp_replace("p_name", " ", "_").alias("n"), "p_type")

    b, n = F.col("b"), F.col("n")

    def name(*parts):
        return F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in parts]).alias("table_name")
    names = (p.select(name("silver_", b, "_", n))
             .union(p.filter("p_type = 'ECONOMY'").select(name("silver_", b, "_", n, "_dbt_tmp")))
             .union(p.filter("p_type = 'SMALL'").select(name("silver_", b, "_lookup_", n)))
             .union(p.filter("p_type = 'LARGE'").select(name("silver_", b, "_", n, "_rm_null")))
             .union(p.filter("p_type = 'PROMO'").select(name("silver_", b, "_latest_ingest")))
             .union(p.filter("p_type = 'MEDIUM'").select(name("bronze_", b, "_", n))))
    kept = tables.export_candidates(names, tables.parse_exclude_list(spark, EXCLUDE_TABLES))
    return kept.select("table_name", study_from_table("table_name").alias("study_id")).distinct()


# --- nonblank_rows ------------------------------------------------------------------------
# Each document is a one-column sheet: line 1 header, line 2 hint, data from
# line 3. A blank header drops the column (and so the sheet); blank rows are
# dropped; values are stripped like Python's str.strip.

@query("nonblank_rows", f"""
WITH l AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents
), x AS (
  SELECT doc_id, lines[1] AS header, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM l
)
SELECT doc_id, CAST(i AS BIGINT) AS src_row,
       regexp_replace(line, '{PY_STRIP_PATTERN}', '', 'g') AS value
FROM x
WHERE i >= 3
  AND regexp_replace(header, '{PY_STRIP_PATTERN}', '', 'g') <> ''
  AND regexp_replace(line, '{PY_STRIP_PATTERN}', '', 'g') <> ''
""")
def nonblank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    d = d.filter(py_strip(F.element_at("lines", 1)) != "")
    rows = d.select("doc_id", F.posexplode("lines").alias("pos", "line")).filter("pos >= 2")
    return rows.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("src_row"),
                       py_strip("line").alias("value")).filter(F.col("value") != "")


# --- split_multivalue -----------------------------------------------------------------------

@query("split_multivalue", f"""
WITH c AS (
  SELECT p_partkey, list_filter(list_transform(string_split(p_name || '; ;' || p_brand || ';' || p_type || ' ;', ';'),
                                               lambda x: regexp_replace(x, '{PY_STRIP_PATTERN}', '', 'g')),
                                lambda x: x <> '') AS vals
  FROM part
)
SELECT p_partkey, CAST(generate_subscripts(vals, 1) AS BIGINT) AS pos, unnest(vals) AS value FROM c
""")
def split_multivalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    cell = F.concat("p_name", F.lit("; ;"), "p_brand", F.lit(";"), "p_type", F.lit(" ;"))
    vals = p.select("p_partkey", promote.split_multivalue(cell).alias("vals"))
    return vals.select("p_partkey", F.posexplode("vals").alias("pos", "value")) \
        .select("p_partkey", (F.col("pos") + 1).cast("bigint").alias("pos"), "value")


# --- silver_shape ---------------------------------------------------------------------------
# Orders as bronze text -> typed silver properties with try_cast.

@query("silver_shape", """
WITH t AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS c, o_orderstatus AS s,
         CAST(o_totalprice AS VARCHAR) AS p, CAST(o_orderdate AS VARCHAR) AS d, o_orderpriority AS pr
  FROM orders
)
SELECT 'orders_' || k AS submitter_id, 'customer_' || c AS customer_id, s AS order_status,
       TRY_CAST(p AS DECIMAL(12,2)) AS total_price,
       CAST(TRY_CAST(substr(d, 1, 4) AS INTEGER) AS BIGINT) AS order_year,
       strftime(TRY_CAST(substr(d, 1, 10) AS DATE), '%Y-%m-%d') AS order_date,
       TRY_CAST(regexp_extract(pr, '^([0-9]+)-', 1) AS BIGINT) AS priority_rank,
       TRY_CAST(s AS BIGINT) AS status_code
FROM t
""")
def silver_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("k"), F.col("o_custkey").cast("string").alias("c"),
        F.col("o_orderstatus").alias("s"), F.col("o_totalprice").cast("string").alias("p"),
        F.col("o_orderdate").cast("string").alias("d"), F.col("o_orderpriority").alias("pr"))
    shaped = promote.silver_shape(o, [
        ("submitter_id", F.concat(F.lit("orders_"), "k"), None),
        ("customer_id", F.concat(F.lit("customer_"), "c"), None),
        ("order_status", "s", None),
        ("total_price", "p", "decimal(12,2)"),
        ("order_year", F.substring("d", 1, 4), "bigint"),
        ("order_date", F.substring("d", 1, 10), "date"),
        ("priority_rank", F.regexp_extract("pr", "^([0-9]+)-", 1), "bigint"),
        ("status_code", "s", "bigint"),
    ])
    return shaped.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


# --- vocab_map ----------------------------------------------------------------------------------

# The priority vocabulary (4-NOT SPECIFIED deliberately unmapped).
PRIORITY_VOCAB = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}


@query("vocab_map", """
SELECT o_orderkey, o_orderpriority, v.term AS priority_term
FROM orders LEFT JOIN (VALUES ('1-URGENT', 'urgent'), ('2-HIGH', 'high'), ('3-MEDIUM', 'medium'), ('5-LOW', 'low'))
  v(source_value, term) ON o_orderpriority = v.source_value
""")
def vocab_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    vocab = promote.vocabulary_frame(spark, PRIORITY_VOCAB)
    return promote.vocab_map(o, "o_orderpriority", vocab, out="priority_term", known_rows=len(PRIORITY_VOCAB))


# --- link_check ----------------------------------------------------------------------------------
# Events link to a customer through ``user_id``; the link target key is made
# ``c_custkey * 2`` so that broken links exist.

@query("link_check", """
SELECT event_id, user_id FROM events e
WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey * 2 = e.user_id)
""")
def link_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("k"))
    return promote.link_check(e, c, "user_id", "k")


# --- link_check_all -----------------------------------------------------------------------------

_LINK_KEYS = {
    ("nation", "region"): ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "nation"): ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "nation"): ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "customer"): ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "orders"): ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "part"): ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "supplier"): ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
}


def _link_all_sql() -> str:
    parts = []
    for child, parent in TESTDATA_LINKS:
        ct, fk, pt, pk = _LINK_KEYS[(child, parent)]
        parts.append(f"""SELECT '{child}' AS child, '{parent}' AS parent, CAST(count(*) AS BIGINT) AS n_children,
  CAST(count(*) FILTER (WHERE {fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {pt} p WHERE p.{pk} = c.{fk})) AS BIGINT)
    AS n_missing FROM {ct} c""")
    return "\nUNION ALL\n".join(parts)


@query("link_check_all", _link_all_sql())
def link_check_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for child, parent in TESTDATA_LINKS:
        ct, fk, pt, pk = _LINK_KEYS[(child, parent)]
        c = table(spark, sf_dir, ct).select(fk)
        row = promote.link_counts(c, table(spark, sf_dir, pt), fk, pk) \
            .select(F.lit(child).alias("child"), F.lit(parent).alias("parent"), "n_children", "n_missing")
        out = row if out is None else out.unionByName(row)
    return out


# --- conform_lineitem -------------------------------------------------------------------------------

@query("conform_lineitem", """
SELECT 'lineitem_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS submitter_id,
       'orders_' || CAST(l_orderkey AS VARCHAR) AS order_id,
       o_orderstatus AS order_status, p_name AS part_name, s_name AS supplier_name,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS revenue
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
""")
def conform_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey) \
        .join(s, li.l_suppkey == s.s_suppkey)
    revenue = (F.col("l_extendedprice").cast("decimal(12,2)")
               * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")
    return j.select(
        F.concat(F.lit("lineitem_"), F.col("l_orderkey"), F.lit("_"), F.col("l_linenumber")).alias("submitter_id"),
        F.concat(F.lit("orders_"), F.col("l_orderkey")).alias("order_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("p_name").alias("part_name"),
        F.col("s_name").alias("supplier_name"), revenue.alias("revenue"))


# --- attach_object_id ----------------------------------------------------------------------------
# Line items are file records keyed by supplier; events are registry
# revisions keyed by user. The newest registration per key supplies the id.

@query("attach_object_id", """
WITH reg AS (
  SELECT user_id, event_id FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
)
SELECT l_orderkey, l_linenumber, l_suppkey, reg.event_id AS object_id
FROM lineitem LEFT JOIN reg ON l_suppkey = reg.user_id
""")
def attach_object_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return promote.attach_object_id(li, e, "l_suppkey", "user_id", "ts", "event_id", tiebreak=("event_id",))


# --- gen3_json ------------------------------------------------------------------------------------

@query("gen3_json", """
SELECT event_id,
       to_json({'type': 'event', 'submitter_id': 'event_' || CAST(event_id AS VARCHAR), 'event_type': event_type,
                'value': value,
                'customers': {'submitter_id': 'customer_' || CAST(user_id AS VARCHAR)}})::VARCHAR AS record
FROM events
""")
def gen3_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    rec = promote.submission_record(e, "event", F.concat(F.lit("event_"), F.col("event_id")), ["event_type", "value"],
                              {"customers": F.concat(F.lit("customer_"), F.col("user_id"))}, keep=["event_id"])
    return rec.select("event_id", F.to_json("record", KEEP_NULLS).alias("record"))
