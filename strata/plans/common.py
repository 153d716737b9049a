"""Shared pieces of the query catalogue: table access, run parameters, the
node model of the testdata and its dictionary.

The testdata stands in for the pipeline's inputs: TPC-H-like tables are
dictionary nodes (``part``/``region`` roots, ``nation``, ``customer`` and
``supplier``, ``orders``, ``lineitem``), regions are studies, and
``submitter_id`` is ``<node>_<key>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a catalogue query and (optionally) its DuckDB oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name!r}")
        REGISTRY[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


_TABLES: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A testdata table. The DataFrame (a plan, not data) is reused within a
    session so the parquet footer is read once per table."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _TABLES[key] = df
    return df


# Run parameters of the catalogue (literals, never a clock).
BATCH_A = "batch-a"
BATCH_B = "batch-b"
INGESTED_A = "2024-02-01T00:00:00+00:00"
INGESTED_B = "2024-03-01T00:00:00+00:00"
VALIDATION_OLD = "20240101T000000000000Z"
VALIDATION_NEW = "20240201T000000000000Z"
SCHEMA_VERSION = "1.0.0"
PROVENANCE = {"g3mt_version": "0.4.2", "schema_file": "dictionary.json"}

# The node-link graph of the testdata (child, parent).
TESTDATA_LINKS = (
    ("nation", "region"),
    ("customer", "nation"),
    ("supplier", "nation"),
    ("orders", "customer"),
    ("lineitem", "orders"),
    ("lineitem", "part"),
    ("lineitem", "supplier"),
)

# The testdata dictionary (a JSON-schema data dictionary).
TESTDATA_DICTIONARY = {
    "_version": SCHEMA_VERSION,
    "_definitions": {
        "money": {"type": "number"},
        "count": {"type": "integer", "minimum": 1},
    },
    "customer": {
        "required": ["submitter_id", "c_name", "c_mktsegment"],
        "properties": {
            "c_name": {"type": "string", "pattern": "^Customer#[0-9]{9}$"},
            "c_mktsegment": {"enum": ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"]},
            "c_acctbal": {"$ref": "#/_definitions/money", "minimum": -900},
            "c_nationkey": {"type": "integer"},
        },
        "links": [{"name": "nations", "target_type": "nation", "required": True}],
    },
    "orders": {
        "required": ["submitter_id", "o_orderstatus", "o_orderdate", "o_clerk"],
        "properties": {
            "o_orderstatus": {"enum": ["F", "O"]},
            "o_totalprice": {"$ref": "#/_definitions/money", "maximum": 450000},
            "o_orderpriority": {"pattern": "^[1-3]-"},
            "o_orderdate": {"format": "date"},
        },
        "links": [{"name": "customers", "target_type": "customer", "required": True}],
    },
    "documents": {
        "required": ["text", "lang"],
        "properties": {
            "lang": {"enum": ["en", "fr", "de"]},
            "n_chars": {"$ref": "#/_definitions/count", "maximum": 20000},
            "quality": {"type": "integer"},
            "source": {"pattern": "^src[0-9]$"},
        },
    },
    "conversations": {
        "required": ["text", "role"],
        "properties": {"role": {"enum": ["user", "assistant"]}},
    },
    "event": {
        "required": ["submitter_id"],
        "properties": {"k": {"type": "integer"}},
    },
    "purchase": {"required": ["submitter_id"], "properties": {"k": {"type": "integer"}}},
    "click": {"required": ["submitter_id"], "properties": {"k": {"type": "integer"}}},
    "view": {"required": ["submitter_id"], "properties": {"k": {"type": "integer"}}},
    "region": {"required": ["submitter_id"], "properties": {}},
    "nation": {"required": ["submitter_id"], "properties": {},
               "links": [{"name": "regions", "target_type": "region", "required": True}]},
    "supplier": {"required": ["submitter_id"], "properties": {},
                 "links": [{"name": "nations", "target_type": "nation", "required": True}]},
    "part": {"required": ["submitter_id"], "properties": {}},
    "lineitem": {"required": ["submitter_id"], "properties": {},
                 "links": [{"name": "orders", "target_type": "orders", "required": True},
                           {"name": "parts", "target_type": "part", "required": True},
                           {"name": "suppliers", "target_type": "supplier", "required": True}]},
}


def study_of_region(name_col: Column) -> Column:
    """Study id of a region: its name lower-cased with non-letters removed
    (``MIDDLE EAST`` -> ``middleeast``), so the study is one name segment."""
    return F.lower(F.regexp_replace(name_col, "[^A-Za-z]", ""))


def region_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select("r_regionkey", study_of_region(F.col("r_name")).alias("study_id"))


def nation_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation key -> study. Nation and region are dimension tables; Catalyst
    broadcasts them from their file statistics, AQE re-checks at runtime."""
    n = table(spark, sf_dir, "nation")
    return n.join(region_studies(spark, sf_dir), n.n_regionkey == F.col("r_regionkey")) \
        .select("n_nationkey", "study_id")


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.join(nation_studies(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left") \
        .select(F.concat(F.lit("customer_"), F.col("c_custkey")).alias("submitter_id"), "study_id",
                "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cs = customer_records(spark, sf_dir).select("c_custkey", "study_id")
    return o.join(cs, o.o_custkey == F.col("c_custkey"), "left").select(
        F.concat(F.lit("orders_"), F.col("o_orderkey")).alias("submitter_id"), "study_id",
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left").select(
        F.concat(F.lit("documents_"), F.col("doc_id")).alias("submitter_id"),
        F.col("source").alias("study_id"), "doc_id", "text", "lang", "source", "n_chars", "quality")


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.concat(F.lit("conversations_"), F.col("conv_id"), F.lit("_"), F.col("turn")).alias("submitter_id"),
                    F.lit("synthetic_dialogs").alias("study_id"), "conv_id", "turn", "role", "text")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records whose node is their ``event_type``."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("event_"), F.col("event_id")).alias("submitter_id"),
                    F.lit("events").alias("study_id"), F.col("event_type").alias("node"), "event_id", "event_type", "user_id",
                    F.get_json_object("props", "$.k").alias("k"), "props")


def node_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(node, submitter_id) of every TPC-H-like node record."""
    def ids(name: str, node: str, *key: str) -> DataFrame:
        parts = [F.lit(node)]
        for k in key:
            parts += [F.lit("_"), F.col(k).cast("string")]
        return table(spark, sf_dir, name).select(F.lit(node).alias("node"), F.concat(*parts).alias("submitter_id"))
    return (ids("region", "region", "r_regionkey")
            .unionByName(ids("nation", "nation", "n_nationkey"))
            .unionByName(ids("customer", "customer", "c_custkey"))
            .unionByName(ids("supplier", "supplier", "s_suppkey"))
            .unionByName(ids("part", "part", "p_partkey"))
            .unionByName(ids("orders", "orders", "o_orderkey"))
            .unionByName(ids("lineitem", "lineitem", "l_orderkey", "l_linenumber")))
