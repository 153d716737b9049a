"""Run and data audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a download probe's outcome means.
DOWNLOAD_MEANINGS = (
    (404, "not registered"),
    (401, "authorisation gap"),
    (500, "service fault"),
)
NO_LOCATION = "no location"
DOWNLOAD_OK = "ok"


def row_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """A5: rows per group (partial aggregation before the shuffle)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_ratio(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows vs distinct keys. Computed as a two-level aggregation (per
    key, then global) so no single task sees all keys."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(
        F.sum("__n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.when(F.col("__n") > 1, 1).otherwise(0)).cast("bigint").alias("n_repeated_keys"),
    ).withColumn("dup_ratio", F.round(F.col("n_rows").cast("decimal(20,0)") / F.col("n_keys"), 4)
                 .cast("decimal(12,4)"))


def batch_inventory(df: DataFrame, batch_col: str = "_src_batch_id",
                    ingested_col: str = "_src_ingested_at") -> DataFrame:
    """A10: rows and ingest time per batch; batch ids are opaque, so order by
    ingest time."""
    return (df.groupBy(batch_col)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.max(ingested_col).alias("ingested_at"))
            .orderBy("ingested_at", batch_col))


def outcome_tally(units: DataFrame, name: str = "unit", status: str = "status", failed: str = "failed") -> DataFrame:
    """Unit counts per outcome, with the names of the failed ones sorted
    (null for other outcomes: only failures are listed)."""
    listed = F.sort_array(F.collect_list(F.when(F.col(status) == failed, F.col(name))))
    return units.groupBy(status).agg(
        F.count(F.lit(1)).alias("n_units"),
        F.nullif(F.array_join(listed, ","), F.lit("")).alias("names"))


def download_meaning(status: Column, urls: Column | None = None) -> Column:
    """What a download-check status means; an empty url list is 'no
    location' whatever the status."""
    expr = F.when(F.lit(False), F.lit(None))
    if urls is not None:
        expr = F.when(F.coalesce(F.size(urls), F.lit(0)) <= 0, F.lit(NO_LOCATION))
    for code, meaning in DOWNLOAD_MEANINGS:
        expr = expr.when(status == code, F.lit(meaning))
    return expr.when((status >= 200) & (status < 300), F.lit(DOWNLOAD_OK)).otherwise(F.lit("unexpected status"))
