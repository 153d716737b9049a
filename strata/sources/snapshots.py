"""Partitions by listing: the greatest snapshot or run of a table is known
from the names of its folders, and reading it costs that folder alone (S10,
A4, W4). No file of another snapshot is listed or opened."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the folder name of a null partition value.
_NULL = "__HIVE_DEFAULT_PARTITION__"
# Characters that partition folders write as %XX, beside control
# characters.
_ESCAPED = frozenset("\"#%'*/:=?\\\x7f{[]^")


def partition_folder(column: str, value: str | None) -> str:
    """The folder name of a partition value."""
    if value is None or value == "":
        return f"{column}={_NULL}"
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in value)


def partition_folders(spark: SparkSession, path: str, column: str) -> list[tuple[str, str]]:
    """(value, folder) of the partitions right under ``path``: one listing of
    one folder. Nulls, hidden folders and folders of other columns are left
    out; a path that is not there has none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    names = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(at) if s.isDirectory()]
    return sorted((unquote(n[len(column) + 1:]), p) for n, p in names
                  if n.startswith(f"{column}=") and n != f"{column}={_NULL}")


def greatest_partition(spark: SparkSession, path: str, column: str, key: Callable = str) -> str | None:
    """The greatest value of the partition column, in the order of ``key``
    (``int`` for numbers; text as it is)."""
    return max((v for v, _ in partition_folders(spark, path, column)), key=key, default=None)


def read_partition(spark: SparkSession, path: str, column: str, value: str, fmt: str = "parquet", **options) -> DataFrame:
    """One partition of a table, with the partition column. Spark is given the
    one folder: it lists and opens nothing else."""
    folder = f"{path.rstrip('/')}/{partition_folder(column, value)}"
    return spark.read.format(fmt).options(**options).option("basePath", path).load(folder)


def read_greatest(spark: SparkSession, path: str, column: str, fmt: str = "parquet", key: Callable = str, **options) -> DataFrame:
    """The rows of the greatest partition. A table without any is an error."""
    top = greatest_partition(spark, path, column, key)
    if top is None:
        raise LookupError(f"{path} has no partition of '{column}'")
    return read_partition(spark, path, column, top, fmt, **options)


def snapshot_listing(spark: SparkSession, root: str, table: str = "table_name", column: str = "snapshot_id") -> DataFrame:
    """(table_name, snapshot_id) of all tables under ``root``, from folder
    names; metadata-sized. Feeds ``release.latest_snapshots``."""
    rows = [(t, int(v)) for t, folder in partition_folders(spark, root, table) for v, _ in partition_folders(spark, folder, column)]
    return spark.createDataFrame(rows, f"{table} string, {column} bigint").select(F.col(table), F.col(column))
