"""Sinks (K1, K3, K4, K5, K6, K7, K8, K10) and write-before-raise.

Every writer is one DataFrame write: partitioned where the reference uses a
key layout, append-only where the reference appends. Output files are JSON
Lines / text part files inside the key directory; one physical file per key
would need ``coalesce(1)`` and does not scale, so it is only used for the
one-line import-order text.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.release import append_ledger_rows, not_ci
from strata.sinks import schema_ledger
from strata.sinks.manifest import write_committed
from strata.sources.snapshots import partition_folder, read_greatest

BRONZE_PARTITION = "_src_batch_id"
# Partition of the run that appended: bookkeeping, dropped on read.
RUN_PARTITION = "_run_key"
# JSON records keep null fields (``"x": null``): a null in a dumped record is
# what the dictionary's type checks report as a null-typed field.
KEEP_NULLS = {"ignoreNullFields": "false"}
DUMP_KEYS = ("study_id", "validation_id", "table_name", "snapshot_id")
EXPORT_KEYS = ("release_dir", "study_id", "write_table")
# Models of several gold databases may share a name.
EXPORT_UNIT = (*EXPORT_KEYS, "db_name")
RESULTS_UNIT = ("validation_id", RUN_PARTITION)


def _replace_own_partitions(df: DataFrame, path: str, fmt: str, *partitions: str) -> None:
    """Write ``df`` replacing only the partitions it contains. Partitions end
    in a key of the run that writes them, so earlier runs are never touched
    and a retry with the same key replaces its own output alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .format(fmt).partitionBy(*partitions).save(path)


def new_run_key() -> str:
    """A key for one append; a caller that may be retried keeps its own."""
    return uuid.uuid4().hex


def append_bronze(df: DataFrame, path: str, fmt: str = "parquet", table: str | None = None,
                  run_key: str | None = None) -> None:
    """Append partitioned by batch and by the appending run. Nothing
    that is there is rewritten, also not by a second append under one batch
    id; a retry with the same ``run_key`` replaces what it had written itself.
    New columns are allowed (read back with ``read_bronze``). With ``table``
    and an Iceberg/Delta catalog, ``writeTo(table).append()`` is used."""
    if table is not None:
        df.writeTo(table).append()
        return
    key = run_key or new_run_key()
    schema_ledger.record(df.sparkSession, path, StructType([f for f in df.schema if f.name != BRONZE_PARTITION]), run_key=key)
    _replace_own_partitions(df.withColumn(RUN_PARTITION, F.lit(key)), path, fmt, BRONZE_PARTITION, RUN_PARTITION)


def read_bronze(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """Bronze with every batch's columns, as its schema ledger lists them; no
    footer is opened to find them. A table without a ledger is read by merging
    the schemas of its files."""
    if not schema_ledger.exists(spark, path):
        return spark.read.format(fmt).option("mergeSchema", "true").load(path).drop(RUN_PARTITION)
    schema = StructType([*schema_ledger.columns(spark, path), *[StructField(c, StringType()) for c in (BRONZE_PARTITION, RUN_PARTITION)]])
    return spark.read.schema(schema).format(fmt).load(path).drop(RUN_PARTITION)


def dump_json(records: DataFrame, root: str, keys: Sequence[str] = DUMP_KEYS) -> None:
    """K3: one JSON line per record under ``<key>=<value>/...`` directories.
    ``records`` carries the key columns plus the record columns."""
    rest = [c for c in records.columns if c not in keys]
    out = records.select(*keys, F.to_json(F.struct(*rest), KEEP_NULLS).alias("value"))
    _replace_own_partitions(out, root, "text", *keys)


def export_release(model: DataFrame, root: str, *unit: str) -> int:
    """K4: one gold model at its pin under ``release_dir=v<tag>/study_id=/
    write_table=/db_name=`` (``unit``, in this order) as JSON lines (``record``
    column already JSON), committed when they can be read back. A model without
    records takes away what an earlier export left. Returns the number of
    records."""
    rows = model.select(*[F.lit(v).alias(k) for k, v in zip(EXPORT_UNIT, unit)], F.col("record").alias("value"))
    n = write_committed(rows, root, EXPORT_UNIT, [unit], run_key=new_run_key(), fmt="text")
    if not n:
        spark = model.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path("/".join([root.rstrip("/"), *map(partition_folder, EXPORT_UNIT, unit)]))
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return n


def write_import_order(order: DataFrame, prefixes: DataFrame, root: str) -> None:
    """K5: the same import-order text once per release and study (``prefixes``
    has release_dir and study_id), beside what other releases wrote. The order
    is dictionary-sized: one text value, stamped on each prefix row."""
    text = order.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "node"))),
                                              lambda s: s["node"]), "\n").alias("t"))
    line = text.first()["t"] or ""
    _replace_own_partitions(prefixes.select("release_dir", "study_id").distinct().withColumn("value", F.lit(line)),
                            root, "text", "release_dir", "study_id")


def append_results(results: DataFrame, path: str, fmt: str = "parquet", run_key: str | None = None) -> None:
    """K6: all studies' findings in one append, partitioned by validation id
    (a gate reads one run's partition) and by the append, and committed. No
    append touches another's rows, also not under one validation id. A caller
    that retries keeps its ``run_key``; without one the key is made of the
    rows, so the same rows again replace themselves. Rows whose validation id
    could not be determined are kept from every append."""
    key = F.lit(run_key or _content_key(results))
    key = key if run_key else F.when(F.col("validation_id").isNull(), F.lit(new_run_key())).otherwise(key)
    keyed = results.withColumn(RUN_PARTITION, key)
    units = [tuple(r) for r in keyed.select(*RESULTS_UNIT).distinct().collect()]  # one or two a run
    write_committed(keyed, path, RESULTS_UNIT, units, run_key=run_key or units[0][1] if units else "", fmt=fmt)


def _content_key(rows: DataFrame) -> str:
    """A key that equal rows share, in any order."""
    h = F.xxhash64(*[F.col(c) for c in sorted(rows.columns)]).cast("decimal(20,0)")
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("s")).first()
    return hashlib.sha256(f"{r.n}:{r.s}".encode()).hexdigest()[:32]


def read_results(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """The results of all runs."""
    return spark.read.format(fmt).load(path).drop(RUN_PARTITION)


def read_latest_results(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """A4: the run with the greatest validation id. It is known from folder
    names; no file of a past run is listed or opened."""
    return read_greatest(spark, path, "validation_id", fmt).drop(RUN_PARTITION)


def results_csv(results: DataFrame, path: str) -> None:
    """K7: the run's results as CSV with a header, beside the JSONs."""
    results.write.mode("overwrite").option("header", "true").csv(path)


def append_ledger(existing: DataFrame, rows: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """K8: idempotent ledger append (CI databases never pinned). Returns the
    rows written."""
    todo = append_ledger_rows(existing, rows.filter(not_ci("db_name")))
    todo.write.mode("append").format(fmt).save(path)
    return todo


def write_snapshot(df: DataFrame, path: str, snapshot_id: int, fmt: str = "parquet") -> None:
    """Commit a table state as snapshot partition ``snapshot_id``."""
    _replace_own_partitions(df.withColumn("snapshot_id", F.lit(snapshot_id).cast("bigint")), path, fmt,
                            "snapshot_id")


class PartialFailure(RuntimeError):
    """Raised after the good units were written, naming the failed ones."""


#: Failures named in an exception; all are in the findings written before it.
NAMED_FAILURES = 20


def name_some(failures: Sequence[str]) -> str:
    shown = sorted(failures)[:NAMED_FAILURES]
    more = len(failures) - len(shown)
    return ", ".join(shown) + (f" and {more} more" if more else "")


def run_units(units: Sequence, work: Callable, workers: int = 8) -> list[tuple[object, Exception]]:
    """Spark jobs of several units (tables, models) side by side; every unit
    is tried. Returns the failed ones with their exceptions."""
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(units) or 1))) as pool:
        jobs = [(u, pool.submit(work, u)) for u in units]
    return [(u, j.exception()) for u, j in jobs if j.exception() is not None]
