"""Schema ledger: the columns of every append, kept as rows.

A table whose batches have differing columns is read with the union of what
its ledger lists. No footer of the table is opened for that, however many files
it has. The ledger lies in ``_columns`` beside the data, one partition an
append; a retry under one run key replaces its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from strata.sources.snapshots import partition_folders

LEDGER = "_columns"
_ROW = "pos int, column string, type string"


class ColumnTypeChanged(ValueError):
    """A batch brings a column in another type than the table has it."""


def _at(path: str) -> str:
    return f"{path.rstrip('/')}/{LEDGER}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(_at(path))
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at))


def entries(spark: SparkSession, path: str) -> DataFrame:
    """pos, column, type and run_key of every append."""
    return spark.read.schema(f"{_ROW}, run_key string").parquet(_at(path))


def columns(spark: SparkSession, path: str) -> StructType:
    """All columns of the table, those of earlier positions first."""
    rows = entries(spark, path).groupBy("column").agg(F.min("pos").alias("pos"), F.first("type").alias("type")) \
        .orderBy("pos", "column").collect()  # one row a column
    return StructType([StructField(r.column, DataType.fromDDL(r.type)) for r in rows])


def record(spark: SparkSession, path: str, schema: StructType, *, run_key: str) -> None:
    """Add an append's columns; called before its data is written, so no file
    ever holds a column that the ledger lacks."""
    if exists(spark, path):
        known = {f.name: f.dataType for f in columns(spark, path)}
        changed = [f"{f.name}: {known[f.name].simpleString()} -> {f.dataType.simpleString()}" for f in schema
                   if f.name in known and known[f.name] != f.dataType]
        if changed:
            raise ColumnTypeChanged(f"{path}: {', '.join(changed)}")
    rows = [(i, f.name, f.dataType.simpleString(), run_key) for i, f in enumerate(schema)]
    spark.createDataFrame(rows, f"{_ROW}, run_key string").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_key").parquet(_at(path))


def columns_per_batch(spark: SparkSession, path: str, batch: str = "_src_batch_id", run: str = "_run_key") -> DataFrame:
    """(batch_id, columns) of every batch, sorted; which append belongs to
    which batch is known from the table's folders."""
    folders = [(b, r) for b, folder in partition_folders(spark, path, batch) for r, _ in partition_folders(spark, folder, run)]
    of = spark.createDataFrame(folders, "batch_id string, run_key string")
    return entries(spark, path).join(of, "run_key").groupBy("batch_id").agg(F.sort_array(F.collect_set("column")).alias("columns"))
