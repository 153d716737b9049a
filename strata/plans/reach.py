"""Catalogue: parts of a run that other queries do not reach: releases chosen
by hand, the database of a model, tagged deposits, one study's workbooks, a
dry run, all sheets of a workbook, custom steps and checks, sources of other
formats (T2, F7, X17, J7, F10, S8, F4, K9, S7, E2, E3, S6, S16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.extend import StepRegistry, custom_check
from strata.functions.text import release_tag_from_git
from strata.operators import landing, release
from strata.plans.common import BATCH_A, INGESTED_A, SCHEMA_VERSION, VALIDATION_NEW, customer_records, query, region_studies, table
from strata.plans.job_rows import _CUSTOMERS, _STUDY, _fresh
from strata.plans.workbooks import CHUNK, HEADERS, HINTS, META, customer_workbooks
from strata.sources import files, workbook

# --- release_override: a release named by its tag, not the latest ---------------------

OLD_RELEASE = "1.7"


def _database(segment: Column) -> Column:
    return F.when(segment == "BUILDING", "ci_gold").when(segment == "MACHINERY", "silver_real").otherwise("real_gold")


_DATABASE = "CASE c_mktsegment WHEN 'BUILDING' THEN 'ci_gold' WHEN 'MACHINERY' THEN 'silver_real' ELSE 'real_gold' END"


@query("release_override", f"""
SELECT '{OLD_RELEASE}' AS release_tag, {_DATABASE} AS db_name, 'model_' || CAST(c_custkey AS VARCHAR) AS model_name,
       CAST(c_custkey AS BIGINT) AS snapshot_id
FROM customer WHERE '1.' || CAST(c_nationkey AS VARCHAR) = '{OLD_RELEASE}' AND c_mktsegment <> 'MACHINERY'
""")
def release_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Git tags ``data-v1.<nation>``: the ledger's tags drop the prefix (X17),
    a given tag wins over the latest (T2), its gold rows are the release (F7)."""
    git_tag = F.concat(F.lit("data-v1."), F.col("c_nationkey").cast("string"))
    ledger = table(spark, sf_dir, "customer").select(
        release_tag_from_git(git_tag).alias("release_tag"), _database(F.col("c_mktsegment")).alias("db_name"),
        F.concat(F.lit("model_"), F.col("c_custkey").cast("string")).alias("model_name"), F.col("c_custkey").cast("long").alias("snapshot_id"))
    return release.release_rows(ledger, release.latest_release(ledger, override=OLD_RELEASE))


# --- model_database: a catalog listing names the database of each model ---------------

@query("model_database", f"""
WITH listing AS (SELECT {_DATABASE} AS db_name, c_name AS model_name FROM customer)
SELECT c_name AS model_name, l.db_name FROM customer
LEFT JOIN (SELECT * FROM listing WHERE NOT starts_with(db_name, 'ci_')) l ON l.model_name = c_name
""")
def model_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models that stand in a CI database alone have none."""
    c = table(spark, sf_dir, "customer")
    listing = c.select(_database(F.col("c_mktsegment")).alias("db_name"), F.col("c_name").alias("table_name"))
    return release.resolve_model_db(listing, c.select(F.col("c_name").alias("model_name"))).select("model_name", "db_name")


# --- tagged_deposits: only objects whose tag says so are taken in ---------------------

@query("tagged_deposits", """
SELECT DISTINCT page_id, url AS path FROM pages
WHERE url IN (SELECT url FROM pages WHERE strpos(html, '<html') > 0 AND strpos(url, '?') = 0)
""")
def tagged_deposits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest may name a path twice, carry other tags, and spell the
    value in any case; the listing's rows do not multiply."""
    p = table(spark, sf_dir, "pages")
    listing = p.select("page_id", F.col("url").alias("path"))
    tag = p.select(F.col("url").alias("path"), F.lit("ingest").alias("tag"),
                   F.when(F.col("html").contains("<html") & ~F.col("url").contains("?"), "TRUE").otherwise("false").alias("value"))
    other = p.select(F.col("url").alias("path"), F.lit("reviewed").alias("tag"), F.lit("true").alias("value"))
    return files.tagged_files(listing, tag.unionByName(tag).unionByName(other)).distinct()


# --- study_workbooks: one study of a deposit listing -----------------------------------

@query("study_workbooks", """
SELECT 's3://bucket/lake/submissions/nation7/' || c_name || CASE c_mktsegment WHEN 'BUILDING' THEN '.XLSX' ELSE '.xlsx' END AS path,
       'nation7' AS study_id
FROM customer WHERE c_nationkey = 7 AND c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')
""")
def study_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """workbooks in any case of the extension; no lock files, no CSV."""
    segment = F.col("c_mktsegment")
    name = F.concat(F.when(segment == "FURNITURE", "~$").otherwise(""), F.col("c_name"),
                    F.when(segment == "BUILDING", ".XLSX").when(segment == "MACHINERY", ".csv").otherwise(".xlsx"))
    path = F.concat(F.lit("s3://bucket/lake/submissions/nation"), F.col("c_nationkey").cast("string"), F.lit("/"), name)
    listing = table(spark, sf_dir, "customer").select(path.alias("path"))
    return workbook.with_study(listing, "s3://bucket/lake", "submissions", "nation7").select("path", "study_id")


# --- workbook_dry_run, workbook_all_sheets ---------------------------------------------

@query("workbook_dry_run", f"""
WITH layout AS (SELECT list_sort([regexp_replace(lower(h), '[^a-z0-9_]', '_', 'g') FOR h IN {HEADERS} IF h <> ''])
                       || {list(landing.PROVENANCE_COLUMNS)} AS columns)
SELECT t.table_name, t.n_rows, layout.columns, len(layout.columns) AS n_columns
FROM (SELECT 'bronze_nation' || CAST(c_nationkey AS VARCHAR) || '_customer' AS table_name, count(*) AS n_rows FROM customer GROUP BY c_nationkey) t
CROSS JOIN layout
""")
def workbook_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: what a run would write (rows and columns of each table), and nothing
    written to bronze."""
    landed = workbook.land_contents(customer_workbooks(spark, sf_dir)).filter(F.col("error").isNull())
    return landing.dry_run_report(landing.bronze_from_cells(landed, batch_id=BATCH_A, ingested_at=INGESTED_A))


@query("workbook_all_sheets", f"""
WITH books AS (SELECT 'nation' || CAST(c_nationkey AS VARCHAR) AS study_id, count(*) AS n FROM customer GROUP BY c_nationkey, c_custkey // {CHUNK})
SELECT study_id, 'Customer' AS sheet, CAST(sum(n) AS BIGINT) AS n_rows, '{len(HINTS) - 1}' AS n_headers FROM books GROUP BY study_id
UNION ALL SELECT study_id, '_g3mt', count(*) * {len(META)}, '2' FROM books GROUP BY study_id
""")
def workbook_all_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sheet under its own name, the metadata sheet too; of its rows
    the first is taken for the headers, the second for the hints. The
    provisioned blank rows of a data sheet are none."""
    landed = workbook.land_contents(customer_workbooks(spark, sf_dir), all_sheets=True).filter(F.col("error").isNull())
    return landed.groupBy("study_id", "sheet").agg(F.count(F.lit(1)).alias("n_rows"),
                                                   F.max(F.size("headers")).cast("string").alias("n_headers"))


# --- custom_steps: registered steps and checks of a user's own --------------------------

@query("custom_steps", f"""
SELECT study_id, submitter_id, 'FAIL' AS validation_result, 'customer/custom/balance' AS schema_path,
       'balance of ' || c_name || ' is below its floor' AS validation_error
FROM ({_CUSTOMERS}) WHERE c_acctbal < CASE WHEN c_mktsegment = 'BUILDING' THEN 100 ELSE 0 END
""")
def custom_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One step adds a column, the next turns a predicate into findings."""
    steps = StepRegistry()

    @steps.step("floors")
    def floors(df: DataFrame) -> DataFrame:
        return df.withColumn("floor", F.when(F.col("c_mktsegment") == "BUILDING", 100).otherwise(0))

    @steps.step("balances")
    def balances(df: DataFrame) -> DataFrame:
        said = F.concat(F.lit("balance of "), F.col("c_name"), F.lit(" is below its floor"))
        return custom_check(df, node="customer", name="balance", fails=F.col("c_acctbal") < F.col("floor"), message=said,
                            validation_id=VALIDATION_NEW, schema_version=SCHEMA_VERSION)

    found = steps.run("balances", steps.run("floors", customer_records(spark, sf_dir)))
    return found.select("study_id", "submitter_id", "validation_result", "schema_path", "validation_error")


# --- json_landing, orc_landing: deposits of other formats -------------------------------

@query("json_landing", f"""
SELECT study_id, submitter_id, c_name, CAST(NULL AS VARCHAR) AS broken FROM ({_CUSTOMERS})
UNION ALL SELECT {_STUDY}, NULL, NULL, '{{"submitter_id": ' || {_STUDY} FROM region
""")
def json_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no JSON are kept as they stand."""
    path = _fresh(spark, "json")
    good = customer_records(spark, sf_dir).select("study_id", F.to_json(F.struct("submitter_id", "c_name")).alias("value"))
    bad = region_studies(spark, sf_dir).select("study_id", F.concat(F.lit('{"submitter_id": '), F.col("study_id")).alias("value"))
    good.unionByName(bad).write.partitionBy("study_id").text(path)
    read = files.read_json_tolerant(spark, [path], multiline=False)
    return read.select("study_id", "submitter_id", "c_name", F.col(files.CORRUPT_COLUMN).alias("broken"))


@query("orc_landing", f"SELECT study_id, submitter_id, c_acctbal FROM ({_CUSTOMERS}) WHERE c_acctbal > 5000")
def orc_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any source of Spark's stands ahead of the bronze contract."""
    path = _fresh(spark, "orc")
    customer_records(spark, sf_dir).write.orc(path)
    return files.read_source(spark, "orc", path).filter(F.col("c_acctbal") > 5000).select("study_id", "submitter_id", "c_acctbal")
