"""Which layer tables a job works on.

Table lists are catalog metadata; they are still handled as DataFrames so
the same filters apply to listings, ledgers and artefact keys alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Silver tables the validation export skips.
SKIP_SUFFIX = "_dbt_tmp"
SKIP_INFIXES = ("lookup", "_rm_null", "latest_ingest")
# Per target, the key prefix and results table (never shared).
TARGETS = {
    "real": {"namespace_prefix": "", "key_prefix": "validation", "results_table": "full_validation_results"},
    "ci": {"namespace_prefix": "ci_", "key_prefix": "ci_validation", "results_table": "ci_full_validation_results"},
}


def is_exportable(name: Column | str) -> Column:
    """starts ``silver``, not a dbt temp table, not a lookup/rm_null/
    latest_ingest helper."""
    c = F.col(name) if isinstance(name, str) else name
    cond = c.startswith("silver") & ~c.endswith(SKIP_SUFFIX)
    for infix in SKIP_INFIXES:
        cond = cond & ~c.contains(infix)
    return cond


def parse_exclude_list(spark: SparkSession, text: str) -> DataFrame:
    """comma list -> trimmed, non-empty names (one column ``table_name``)."""
    raw = spark.createDataFrame([(text or "",)], "s string")
    return (raw.select(F.explode(F.split("s", ",", -1)).alias("x"))
            .select(F.trim("x").alias("table_name")).filter(F.col("table_name") != "").distinct())


def export_candidates(names: DataFrame, exclude: DataFrame | None = None, column: str = "table_name") -> DataFrame:
    """F5 + U3: exportable tables minus the exclude list (left anti)."""
    kept = names.filter(is_exportable(column))
    if exclude is not None:
        kept = kept.join(exclude.select(F.col("table_name").alias("__x")), F.col(column) == F.col("__x"), "left_anti")
    return kept


def list_layer_tables(spark: SparkSession, database: str) -> DataFrame:
    """Table names of one layer database as a DataFrame."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return spark.createDataFrame([(n,) for n in names], "table_name string")


def target(name: str) -> dict:
    """the settings of a validation target (``real`` or ``ci``)."""
    if name not in TARGETS:
        raise ValueError(f"unknown target {name!r}; expected one of {sorted(TARGETS)}")
    return TARGETS[name]
