"""Other deposit sources.

Ingestion is free as long as rows land in the bronze contract; these readers
cover the documented tolerant CSV/JSON paths, tag-filtered listings and the
validation-artefact listing.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.positions import line_positions
from strata.sources import csv_records

# Delimiters a tolerant CSV read chooses between.
CANDIDATE_DELIMITERS = (",", ";", "\t", "|")
CORRUPT_COLUMN = "_corrupt_record"
SOURCE_COLUMN = "_src_file"


def _lines(spark: SparkSession, paths: Sequence[str], encoding: str | None) -> DataFrame:
    """file, split, at and line of every line, with its place in the file.
    Bytes that are not valid UTF-8 are read as Latin-1 unless an encoding is
    named."""
    value = F.decode(F.col("value").cast("binary"), encoding) if encoding else \
        F.when(F.expr("is_valid_utf8(value)"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    raw = spark.read.text(list(paths)).select(F.regexp_replace(value, "^\ufeff|\r$", "").alias(csv_records.LINE))
    return line_positions(raw, name=csv_records.AT, split=(csv_records.FILE, csv_records.SPLIT))


def _layouts(lines: DataFrame, delimiter: str | None) -> DataFrame:
    """Per file its header line (the first line that is not blank), where it
    stands, and the delimiter: the candidate that occurs most often in it."""
    first = lines.filter((F.col("split") == 0) & (F.trim("line") != "")) \
        .groupBy("file").agg(F.min_by("line", "at").alias("header"), F.min("at").alias("header_at"))
    if delimiter is not None:
        return first.withColumn("delimiter", F.lit(delimiter))
    seen = {d: F.length("header") - F.length(F.replace(F.col("header"), F.lit(d), F.lit(""))) for d in CANDIDATE_DELIMITERS}
    pick = F.lit(CANDIDATE_DELIMITERS[0])
    for d in reversed(CANDIDATE_DELIMITERS):
        pick = F.when(seen[d] == F.greatest(*seen.values()), F.lit(d)).otherwise(pick)
    return first.withColumn("delimiter", pick)


def csv_layouts(spark: SparkSession, paths: Sequence[str], encoding: str | None = None,
                delimiter: str | None = None) -> DataFrame:
    """(file, header, delimiter) of every file that has a line."""
    return _layouts(_lines(spark, paths, encoding), delimiter).drop("header_at")


def _header_names(header: str, delimiter: str) -> list[str]:
    names: list[str] = []
    for i, cell in enumerate(next(csv.reader([header], delimiter=delimiter))):
        base = cell.strip() or f"_c{i}"
        free = (base if n == 1 else f"{base}_{n}" for n in count(1))
        names.append(next(name for name in free if name not in [*names, CORRUPT_COLUMN, SOURCE_COLUMN]))
    return names


def read_csv_tolerant(spark: SparkSession, paths: Sequence[str], encoding: str | None = None,
                      delimiter: str | None = None) -> DataFrame:
    """Header CSV, all columns text, stacked by name. Every file is read
    by its own header and delimiter: files with the same header line form one
    layout, and there is one parse per layout, whatever the number of files.

    Cells in quotes may hold delimiters, doubled quotes and line feeds (a
    carriage return before one is not kept); see ``csv_records``. Records with
    too few or too many cells keep what could be read and the whole record in
    ``_corrupt_record``; so does each line from a quote on that its file never
    closes, without cells. A file's header is its first line that is not blank,
    and that one alone: a record that repeats it is data. Blank records, and
    files without a line, contribute nothing."""
    lines = _lines(spark, paths, encoding)
    layouts = _layouts(lines, delimiter)
    rows = csv_records.assemble(lines.join(layouts.select("file", "delimiter"), "file")) \
        .join(layouts.withColumnRenamed("file", "__file"), F.col("file") == F.col("__file")) \
        .filter((F.col("at") > F.col("header_at")) & (F.trim("record") != ""))
    out = None
    for r in layouts.select("header", "delimiter").distinct().collect():  # one row a layout
        names = _header_names(r.header, r.delimiter)
        schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, CORRUPT_COLUMN])
        own = rows.filter((F.col("header") == r.header) & (F.col("delimiter") == r.delimiter))
        parsed = F.from_csv(F.when(~F.col("open"), F.col("record")), F.lit(schema), {
            "sep": r.delimiter, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
        part = own.select(parsed.alias("r"), F.when(F.col("open"), F.col("record")).alias("__open"), F.col("file").alias(SOURCE_COLUMN)) \
            .select(*[F.col("r")[n].alias(n) for n in names], F.coalesce("__open", F.col("r")[CORRUPT_COLUMN]).alias(CORRUPT_COLUMN), SOURCE_COLUMN)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out if out is not None else spark.createDataFrame([], f"{CORRUPT_COLUMN} string, {SOURCE_COLUMN} string")


def read_json_tolerant(spark: SparkSession, paths: Sequence[str], multiline: bool = True) -> DataFrame:
    """JSON (array or objects), bad records kept in ``_corrupt_record``."""
    return (spark.read.option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(list(paths))
            .withColumn("_src_file", F.input_file_name()))


def tagged_files(listing: DataFrame, manifest: DataFrame, tag: str = "ingest", value: str = "true") -> DataFrame:
    """Only objects carrying ``tag=value`` (manifest: path, tag, value)."""
    m = manifest.filter((F.col("tag") == tag) & (F.lower("value") == value)).select("path")
    return listing.join(m, "path", "left_semi")


def list_validation_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """One listing of the dump prefix; keys parsed by partition
    discovery (string-typed, so leading zeros survive)."""
    prev = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled", None)
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        # binaryFile with only path and partition columns selected: a listing,
        # no file content is read.
        df = spark.read.format("binaryFile").option("basePath", root).option("recursiveFileLookup", "false") \
            .load(root)
        out = df.select("study_id", "validation_id", "table_name", "snapshot_id", "path")
        out.schema  # resolve partitions while inference is off
    finally:
        if prev is not None:
            spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", prev)
    return out


def read_source(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """Any Spark source (parquet, csv, json, jdbc, ...) ahead of the
    bronze contract."""
    r = spark.read.format(fmt).options(**options)
    return r.load(path) if path else r.load()
