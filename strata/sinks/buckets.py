"""Silver in hash buckets, merged on write.

A row's bucket follows from its ``row_hash``. A batch reads and rewrites the
buckets that it touches, as a new version of each; ``_current`` says which
version counts and is written last, bucket by bucket. A read lists those
versions and is a plain scan: rows of one hash lie in one bucket and were
settled when they were written, so nothing is shuffled and no history is
sorted. Merging is idempotent: a batch that is replayed after a failure settles
what was left undone and changes nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import promote
from strata.sinks import schema_ledger
from strata.sources.snapshots import partition_folders

BUCKET, VERSION, CURRENT = "_bucket", "_version", "_current"
#: Buckets of a new table: rewritten one by one, so about a task's input each
#: at the size the table is meant to reach. Kept with the table.
BUCKETS = 64
_POINTER = f"{VERSION} string, n_rows bigint, buckets int, {BUCKET} int"


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("row_hash"), F.lit(buckets)).cast("int")


def current(spark: SparkSession, path: str) -> DataFrame:
    """_bucket, _version, n_rows, buckets: what a reader sees."""
    if not partition_folders(spark, f"{path.rstrip('/')}/{CURRENT}", BUCKET):
        return spark.createDataFrame([], _POINTER)
    return spark.read.schema(_POINTER).parquet(f"{path.rstrip('/')}/{CURRENT}")


def _load(spark: SparkSession, path: str, versions: Sequence) -> DataFrame:
    """The rows of the given bucket versions, one folder each."""
    schema = schema_ledger.columns(spark, path)
    folders = [f"{path.rstrip('/')}/{BUCKET}={r[BUCKET]}/{VERSION}={r[VERSION]}" for r in versions]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def merge_batch(new_rows: DataFrame, path: str, run_key: str, buckets: int = BUCKETS) -> int:
    """Merge bronze rows into the silver table at ``path``; newest per hash
    wins (W1). New columns are added, null in older rows. Returns how many
    buckets were rewritten. One writer at a time; readers are not disturbed,
    and versions that count no more stay until ``vacuum``."""
    spark = new_rows.sparkSession
    have = {r[BUCKET]: r for r in current(spark, path).collect()}  # one row a bucket
    buckets = next((r.buckets for r in have.values()), buckets)
    batch = promote.dedupe_bronze(new_rows).withColumn(BUCKET, _bucket(buckets))
    touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]
    if not touched:
        return 0
    schema_ledger.record(spark, path, new_rows.schema, run_key=run_key)
    old = _load(spark, path, [have[b] for b in touched if b in have]).withColumn(BUCKET, _bucket(buckets))
    # A version is never written over by a merge that reads it.
    version = f"{run_key}-{uuid.uuid4().hex}"
    merged = promote.dedupe_bronze(old.unionByName(batch, allowMissingColumns=True)).withColumn(VERSION, F.lit(version))
    merged.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, VERSION).parquet(path)
    counts = _load(spark, path, [{BUCKET: b, VERSION: version} for b in touched]).groupBy(_bucket(buckets).alias(BUCKET)) \
        .agg(F.count(F.lit(1)).alias("n_rows"))
    counts.select(F.lit(version).alias(VERSION), "n_rows", F.lit(buckets).alias("buckets"), BUCKET) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{path.rstrip('/')}/{CURRENT}")
    return len(touched)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Silver as of now: a scan of the current version of every bucket."""
    return _load(spark, path, current(spark, path).collect())


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete versions that are not current. Returns their number."""
    keep = {(r[BUCKET], r[VERSION]) for r in current(spark, path).collect()}
    old = [f for b, folder in partition_folders(spark, path, BUCKET) for v, f in partition_folders(spark, folder, VERSION)
           if (int(b), v) not in keep]
    for folder in old:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(old)
