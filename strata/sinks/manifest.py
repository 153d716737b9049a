"""Commit manifest of partitioned tables.

A unit is one partition of a table: its folder. After a write the unit is read
back, and what stands there — rows, an order-free digest, the writing run — is
recorded as the unit's commit, last. Readers take committed units, and
``audit`` names a unit that is half written, written over, or never committed.
Commits lie in ``_commits`` beside the data, which table reads pass over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.sources.snapshots import partition_folder

COMMITS = "_commits"
_COMMIT = "unit string, n_rows bigint, digest string, run_key string, unit_id string"


def _units(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """(unit, n_rows, digest): one row a partition. The digest sums the rows'
    hashes, so it depends on the rows alone, each as often as it is there."""
    values = sorted(c for c in rows.columns if c not in partitions)
    digest = F.sum(F.xxhash64(*[F.col(c) for c in values]).cast("decimal(20,0)")).cast("string")
    unit = F.to_json(F.struct(*[F.col(p).cast("string").alias(p) for p in partitions]), {"ignoreNullFields": "false"})
    return rows.groupBy(unit.alias("unit")).agg(F.count(F.lit(1)).alias("n_rows"), digest.alias("digest"))


def _replace(df: DataFrame, path: str, fmt: str, partitions: Sequence[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt).partitionBy(*partitions).save(path)


def _stored(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return spark.read.format(fmt).load(path)


class IncompleteWrite(RuntimeError):
    """What was read back is not what was written; nothing was committed."""


def write_committed(df: DataFrame, path: str, partitions: Sequence[str], units: Sequence[Sequence[str | None]], *, run_key: str,
                    fmt: str = "parquet") -> int:
    """Replace the partitions that ``df`` has rows for and commit them.
    ``units`` holds the partition values of this write (few): their folders
    alone are listed and read back. Returns the number of rows."""
    spark, seen = df.sparkSession, Observation()
    _replace(df.observe(seen, F.count(F.lit(1)).alias("n")), path, fmt, partitions)
    n = seen.get.get("n") or 0
    if not n:
        return 0
    folders = ["/".join([path.rstrip("/"), *map(partition_folder, partitions, u)]) for u in units]
    rows = _units(spark.read.format(fmt).option("basePath", path).load(folders), partitions) \
        .withColumn("run_key", F.lit(run_key)).withColumn("unit_id", F.md5("unit"))
    rows = spark.createDataFrame(rows.collect(), _COMMIT)  # one row a unit of this write
    read = rows.agg(F.sum("n_rows")).first()[0] or 0
    if read != n:
        raise IncompleteWrite(f"{path}: {n} rows written, {read} read back")
    _replace(rows, f"{path.rstrip('/')}/{COMMITS}", "parquet", ["unit_id"])
    return n


def commits(spark: SparkSession, path: str) -> DataFrame:
    """unit, n_rows, digest, run_key: the last commit of every unit."""
    return spark.read.schema(_COMMIT).parquet(f"{path.rstrip('/')}/{COMMITS}").drop("unit_id")


def read_committed(spark: SparkSession, path: str, partitions: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """The rows of committed units. The join is on partition columns."""
    fields = ", ".join(f"`{p}` string" for p in partitions)
    keys = commits(spark, path).select(F.from_json("unit", fields).alias("u")).select(*[F.col(f"u.{p}").alias(f"__{p}") for p in partitions])
    data = _stored(spark, path, fmt)
    on = [data[p].cast("string").eqNullSafe(F.col(f"__{p}")) for p in partitions]
    return data.join(keys, on, "left_semi")


def audit(spark: SparkSession, path: str, partitions: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """unit, run_key, committed, found (rows) and status of every unit that is
    stored or committed: ``complete``, ``differs`` (other rows than committed),
    ``missing`` (committed, not there) or ``uncommitted``."""
    found = _units(_stored(spark, path, fmt), partitions).select("unit", F.col("n_rows").alias("found"), F.col("digest").alias("__d"))
    both = commits(spark, path).join(found, "unit", "full")
    status = F.when(F.col("n_rows").isNull(), "uncommitted").when(F.col("found").isNull(), "missing") \
        .when((F.col("n_rows") == F.col("found")) & (F.col("digest") == F.col("__d")), "complete").otherwise("differs")
    return both.select("unit", "run_key", F.col("n_rows").alias("committed"), "found", status.alias("status"))
