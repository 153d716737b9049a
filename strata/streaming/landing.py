"""Incremental landing and promotion with Structured Streaming.

Batch remains the definition; these run the same operators per micro-batch:

* R1: ``readStream`` over the deposit folder (``binaryFile`` needs an explicit
  schema), ``trigger(availableNow=True)`` so only files not seen by the
  checkpoint are processed, and ``foreachBatch`` landing each micro-batch with
  batch id ``<run id>-<epoch>``. Workbooks that fail are rows of the findings
  table, and the stream's caller is told (``landing_failures``).
* R2: silver is append-only: a micro-batch adds its newest row per hash as
  partitions of its own, and ``read_silver`` keeps the newest per hash over
  all batches. A small batch writes its own rows and touches nothing else;
  ``compact_silver`` folds the batches together when there are many.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from contextlib import AbstractContextManager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.naming import DEFAULT_PREFIX
from strata.operators import promote
from strata.operators.positions import split_positions
from strata.session import scratch_path
from strata.sinks import writers
from strata.sources import workbook
from strata.sources.records import parse_lines

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def promote_batch(new_rows: DataFrame, silver_path: str, fmt: str = "parquet", run_key: str | None = None) -> None:
    """R2 for one batch of bronze rows: its newest row per hash is appended.
    Replaying the batch under the same ``run_key`` writes the same partitions
    again. Silver is not read, so no read error can be taken for an empty one."""
    writers.append_bronze(promote.dedupe_bronze(new_rows), silver_path, fmt, run_key=run_key)


def read_silver(spark: SparkSession, silver_path: str, fmt: str = "parquet") -> DataFrame:
    """Silver as of now: every batch's columns, the newest row per hash."""
    return promote.dedupe_bronze(writers.read_bronze(spark, silver_path, fmt))


def compact_silver(spark: SparkSession, silver_path: str, target_path: str, fmt: str = "parquet") -> None:
    """Silver's current rows as one generation at a new path (readers move to
    it when it is complete; the old path is untouched)."""
    writers.append_bronze(read_silver(spark, silver_path, fmt), target_path, fmt, run_key="compacted")


def landing_failures(spark: SparkSession, findings_path: str, run_id: str) -> DataFrame:
    """The workbooks a landing run could not take in (file, study_id, error)."""
    return spark.read.parquet(findings_path).filter(
        (F.col("severity") == "error") & F.col("batch_id").startswith(f"{run_id}-"))


def start_workbook_landing(spark: SparkSession, deposit_root: str, bronze_path: str, run_id: str,
                           ingested_at: str, silver_path: str | None = None, prefix: str = DEFAULT_PREFIX,
                           checkpoint: str | None = None, findings_path: str | None = None) -> StreamingQuery:
    """R1 (+R2 when ``silver_path``): land only new workbooks into the same
    per-table bronze layout a batch ingest writes (``<bronze_path>/<table>``),
    one batch partition per micro-batch with batch id ``<run_id>-<epoch>``;
    silver is promoted per table under ``<silver_path>/silver_<study>_<node>``.
    Failures and warnings are appended to ``findings_path`` (by default
    ``<bronze_path>-findings``) with their batch id before the batch commits;
    ``landing_failures`` reads those of a run."""
    p = prefix.strip("/")
    stream = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[xX][lL][sS][xX]")
              .load(f"{deposit_root.rstrip('/')}/{p}"))

    def landed(batch: DataFrame) -> AbstractContextManager[DataFrame]:
        return workbook.landing(workbook.with_study(batch, deposit_root, p, None))
    return _start(spark, stream, landed, bronze_path, run_id, ingested_at, silver_path, checkpoint, findings_path)


def start_record_landing(spark: SparkSession, deposit_root: str, bronze_path: str, run_id: str, ingested_at: str,
                         silver_path: str | None = None, prefix: str = DEFAULT_PREFIX, checkpoint: str | None = None,
                         findings_path: str | None = None) -> StreamingQuery:
    """R1 (+R2) for deposits of JSON lines under ``<prefix>/<study>/<node>/``:
    the rows of files that the checkpoint has not seen, in the layout a
    workbook landing writes. A record's properties are its cells (text as it
    is, other values as JSON, null as empty), ``_src_row`` its line in the
    file. Blank lines are skipped; a line that is no JSON object, or a file
    without study and node folders, gives error rows in the findings, and all
    other lines land."""
    p = prefix.strip("/")
    stream = spark.readStream.format("text").option("recursiveFileLookup", "true").load(f"{deposit_root.rstrip('/')}/{p}") \
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))

    def landed(batch: DataFrame) -> AbstractContextManager[DataFrame]:
        return nullcontext(_record_rows(split_positions(batch, "path", "start", "line"), p))
    return _start(spark, stream, landed, bronze_path, run_id, ingested_at, silver_path, checkpoint, findings_path)


def _record_rows(lines: DataFrame, prefix: str) -> DataFrame:
    """Lines (value, path, line) in the landing form of workbooks."""
    below = F.split(F.regexp_extract("path", f"/{re.escape(prefix)}/(.*)", 1), "/")
    placed = F.size(below) > 2
    parsed = parse_lines(lines.filter(F.trim("value") != "").withColumnRenamed("value", "line_text")
                         .withColumn("at", F.col("line")).drop("line").withColumnRenamed("line_text", "line"))
    cells = F.expr("cast(record as map<string,variant>)")
    cells = F.transform_values(cells, lambda _, v: F.coalesce(v.cast("string"), F.lit("")))
    error = F.when(~placed, F.lit("no study and node folder")).otherwise(F.col("bad"))
    null = F.lit(None)
    return parsed.select(
        F.col("path").alias("file"), F.when(placed, F.get(below, F.lit(0))).alias("study_id"),
        F.when(placed, F.get(below, F.lit(1))).alias("node"), null.cast("string").alias("sheet"),
        (F.col("at") + 1).alias("row"), cells.alias("cells"), error.alias("error")) \
        .select("file", "study_id", "node", "sheet", "row",
                F.when(F.col("error").isNull(), F.array_sort(F.map_keys("cells"))).alias("headers"),
                F.when(F.col("error").isNull(), F.col("cells")).alias("cells"), null.cast("map<string,string>").alias("provenance"),
                "error", F.when(F.col("error").isNotNull(), "error").alias("severity"))


def _start(spark: SparkSession, stream: DataFrame, landed: Callable[[DataFrame], AbstractContextManager[DataFrame]], bronze_path: str, run_id: str,
           ingested_at: str, silver_path: str | None, checkpoint: str | None, findings_path: str | None) -> StreamingQuery:
    def each(batch: DataFrame, epoch: int) -> None:
        from strata.jobs import stage_landing, write_bronze_tables
        batch_id = f"{run_id}-{epoch}"
        with landed(batch) as rows:
            staged = stage_landing(spark, rows, batch_id=batch_id, ingested_at=ingested_at)
        try:
            # Findings first: a batch never commits without them.
            writers.append_bronze(staged.findings.withColumn(writers.BRONZE_PARTITION, F.lit(batch_id))
                                  .withColumn("batch_id", F.lit(batch_id)),
                                  findings_path or bronze_path.rstrip("/") + "-findings", run_key=batch_id)
            write_bronze_tables(staged, bronze_path, run_key=batch_id)
            if silver_path:
                for table_name in staged.tables:
                    silver_name = "silver" + table_name[len("bronze"):]
                    promote_batch(staged.table(table_name), f"{silver_path.rstrip('/')}/{silver_name}", run_key=batch_id)
        finally:
            staged.remove()

    return (stream.writeStream.foreachBatch(each)
            .option("checkpointLocation", checkpoint or scratch_path(spark, f"streams/landing-{run_id}"))
            .trigger(availableNow=True).start())
