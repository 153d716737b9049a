"""Workbook deposits -> landing rows.

Listing is a ``binaryFile`` scan (path only, so file content is pruned). One
stage unpacks the files into stored cells, one row per sheet row; columns turn
them into text, and the rows are written to the shared scratch space once. From
there one aggregate over the heads (metadata sheet, header rows) makes a row
per workbook with its map, provenance, headers and fault; data rows join the
mapped sheets and become header -> text maps.

A workbook lands whole or not at all: whatever fails in it makes its row a
failure, and rows of a failed workbook meet no sheet.

Spark's file sources skip names starting with ``_`` or ``.``; object keys
like that are not listed (the object-store listing would include them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.cells import cell_text
from strata.functions.naming import DEFAULT_PREFIX, is_workbook, study_from_path
from strata.functions.text import py_strip
from strata.session import remove_path, written_at
from strata.sources import xlsx

# Landing form of the reader: one row per data row of a mapped sheet, plus
# one row per file-level failure (``error`` set, ``severity`` 'error') and per
# missing mapped sheet (``severity`` 'warn').
LANDING_SCHEMA = (
    "file string, study_id string, node string, sheet string, row bigint, headers array<string>, "
    "cells map<string,string>, provenance map<string,string>, error string, severity string"
)
LANDING_COLUMNS = [c.split()[0] for c in LANDING_SCHEMA.split(", ")]
# Stored form: per sheet one row without a number, then its rows; a file that
# cannot be read to its end has a row with the error.
STORED_SCHEMA = (
    "file string, study_id string, sheet string, row bigint, date1904 boolean, "
    "cells array<struct<col:int,kind:string,format:int,code:string,value:string>>, error string"
)
#: Cells a worker holds before it hands them on.
BATCH_CELLS = 20_000

# The workbook layout — metadata sheet name, header row, first
# data row (row 2 holds hints and is never data), heading of the map.
META_SHEET = "_g3mt"
HEADER_ROW = 1
FIRST_DATA_ROW = 3
MAP_HEADER = ("node", "sheet")


def _scan(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    base = f"{root.rstrip('/')}/{prefix.strip('/')}"
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.[xX][lL][sS][xX]").load(base))


def with_study(files: DataFrame, root: str, prefix: str, study: str | None) -> DataFrame:
    """Workbooks among ``files`` with their study. The study is the
    first segment below ``root/prefix``; the root is stripped as it was given
    (whatever folder names it repeats), with or without its scheme."""
    base = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", root.rstrip("/")) + "/" + prefix.strip("/") + "/"
    plain = F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    at = F.instr(plain, base)
    rest = F.when(at > 0, F.substr(plain, at + len(base))).otherwise(plain)
    key = F.concat(F.lit(prefix.strip("/") + "/"), rest)
    out = files.withColumn("__key", key).filter(is_workbook("__key")) \
        .withColumn("study_id", study_from_path("__key", prefix.strip("/"))).drop("__key")
    if study is not None:
        out = out.filter(F.col("study_id") == study)
    return out


def list_workbooks(spark: SparkSession, root: str, prefix: str = DEFAULT_PREFIX,
                   study: str | None = None) -> DataFrame:
    """Workbook files under ``root/prefix`` with their study.
    Only ``path`` is selected, so file content is never read."""
    return with_study(_scan(spark, root, prefix).select("path"), root, prefix, study)


def workbook_contents(spark: SparkSession, root: str, prefix: str = DEFAULT_PREFIX, study: str | None = None) -> DataFrame:
    """``path, study_id, content`` of the workbooks; the scan's own splits
    spread them over tasks by size."""
    return with_study(_scan(spark, root, prefix).select("path", "content"), root, prefix, study)


# ------------------------------------------------------------- stored cells

_CELL = pa.struct([("col", pa.int32()), ("kind", pa.string()), ("format", pa.int32()), ("code", pa.string()), ("value", pa.string())])


def _file_rows(path: str, study: str, content: bytes) -> Iterator[tuple]:
    try:
        for sheet, row, date1904, cells in xlsx.stored_rows(content):
            yield path, study, sheet, row, date1904, cells, None
    except Exception as exc:  # noqa: BLE001 - a bad workbook is a failure row, the others load
        yield path, study, None, None, False, [], f"{type(exc).__name__}: {exc}"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    file, study, sheet, row, date1904, cells, error = map(list, zip(*rows))
    ends = [0]
    for c in cells:
        ends.append(ends[-1] + len(c))
    flat = list(zip(*(x for c in cells for x in c))) or [()] * len(_CELL)
    items = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(flat, _CELL)], fields=list(_CELL))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)
    text = pa.string()
    return pa.RecordBatch.from_arrays(
        [pa.array(file, text), pa.array(study, text), pa.array(sheet, text), pa.array(row, pa.int64()),
         pa.array(date1904, pa.bool_()), lists, pa.array(error, text)],
        names=["file", "study_id", "sheet", "row", "date1904", "cells", "error"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, cells = [], 0
    for batch in batches:
        for path, study, content in zip(*(batch.column(c) for c in ("path", "study_id", "content"))):
            for row in _file_rows(path.as_py(), study.as_py(), content.as_py() or b""):
                held.append(row)
                cells += len(row[5]) + 1
                if cells >= BATCH_CELLS:
                    yield _batch(held)
                    held, cells = [], 0
    if held:
        yield _batch(held)


def stored_cells(files: DataFrame) -> DataFrame:
    """The stored form of workbooks given as ``path, study_id, content``."""
    return files.select("path", "study_id", "content").mapInArrow(_unpack, STORED_SCHEMA)


# ------------------------------------------------------------------ meaning

def sheet_rows(stored: DataFrame) -> DataFrame:
    """Stored cells -> ``cells`` (col, stripped text), and the part of a workbook."""
    texts = F.transform("cells", lambda c: F.struct(c["col"].alias("col"), py_strip(cell_text(c, F.col("date1904"))).alias("text")))
    data = (F.col("row") >= FIRST_DATA_ROW) & (F.col("sheet") != META_SHEET)
    return stored.select("file", "study_id", "sheet", "row", texts.alias("cells"), "error",
                         F.when(F.coalesce(data, F.lit(False)), "data").otherwise("head").alias("part"))


def _last_of_key(pairs: Column) -> Column:
    """Pairs as a map; of a key that repeats, the last one counts."""
    later = lambda i: F.slice(pairs, i + 2, F.size(pairs))
    kept = F.filter(pairs, lambda p, i: ~F.exists(later(i), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(F.transform(kept, lambda p: F.struct(p["key"], p["value"])))


def workbooks(rows: DataFrame, all_sheets: bool = False) -> DataFrame:
    """A row per workbook — ``sheets``, ``heads`` (sheet, named columns in
    order; F2 drops those without a name), ``provenance`` (what stands above
    the ``node``/``sheet`` row of the metadata sheet), ``mapping`` node ->
    sheet (what stands below; with ``all_sheets`` every sheet is its own node)
    and ``error``. One aggregate over heads, whose size is metadata."""
    cells, meta = F.col("cells"), F.col("sheet") == META_SHEET
    first = lambda n: F.get(F.filter(cells, lambda c: c["col"] == n), F.lit(0))["text"]
    named = F.array_sort(F.filter(cells, lambda c: c["text"] != ""))
    pair = F.struct("row", first(1).alias("key"), F.coalesce(first(2), F.lit("")).alias("value"))
    heads = rows.filter((F.col("part") == "head") & (F.col("row").isNull() | (F.col("row") == HEADER_ROW) | meta))
    book = heads.groupBy("file", "study_id").agg(
        F.max("error").alias("fault"),
        F.array_sort(F.collect_set(F.when(F.col("row").isNull(), F.col("sheet")))).alias("sheets"),
        F.array_sort(F.collect_list(F.when(F.col("row") == HEADER_ROW, F.struct("sheet", named.alias("cells"))))).alias("heads"),
        F.array_sort(F.collect_list(F.when(meta & first(1).isNotNull(), pair))).alias("pairs"))
    is_map = lambda p: (p["key"] == MAP_HEADER[0]) & (p["value"] == MAP_HEADER[1])
    pairs, split = F.col("pairs"), F.col("split")
    book = book.withColumn("split", F.array_position(F.transform("pairs", is_map), F.lit(True)).cast("int"))
    above = F.when(split > 0, F.slice(pairs, 1, F.greatest(split - 1, F.lit(0)))).otherwise(pairs)
    below = F.filter(F.slice(pairs, split + 1, F.when(split > 0, F.size(pairs)).otherwise(0)), lambda p: ~is_map(p))
    book = book.withColumns({"above": above, "below": below})
    if all_sheets:
        book = book.withColumns({"provenance": F.map_from_arrays(F.slice("sheets", 1, 0), F.slice("sheets", 1, 0)),
                                 "mapping": F.map_from_arrays("sheets", "sheets")})
        layout = F.lit(None).cast("string")
    else:
        book = book.withColumns({"provenance": _last_of_key(F.col("above")), "mapping": _last_of_key(F.col("below"))})
        layout = F.when(~F.array_contains("sheets", META_SHEET), f"sheet '{META_SHEET}' is missing") \
            .when(F.size("mapping") == 0, f"'{META_SHEET}' maps no node to a sheet")
    names = lambda h: h["cells"]["text"]
    repeated = F.get(F.filter("heads", lambda h: F.array_contains(F.map_values("mapping"), h["sheet"])
                              & (F.size(F.array_distinct(names(h))) < F.size(names(h)))), F.lit(0))
    again = F.array_distinct(F.filter(names(repeated), lambda n, i: F.array_position(names(repeated), n) <= i))
    return book.withColumn("error", F.coalesce("fault", layout, F.when(
        repeated.isNotNull(), F.concat(F.lit("headers repeat in sheet '"), repeated["sheet"], F.lit("': "),
                                       F.array_join(F.array_sort(again), ", "))))) \
        .select("file", "study_id", "sheets", "heads", "provenance", "mapping", "error")


def land(rows: DataFrame, all_sheets: bool = False) -> DataFrame:
    """S3/S4 (S7 with ``all_sheets``): ``sheet_rows`` -> landing rows. Give it
    rows that were written (it reads them several times)."""
    books = workbooks(rows, all_sheets)
    good = books.filter(F.col("error").isNull()).select("file", "study_id", "provenance", "sheets", "heads",
                                                        F.explode("mapping").alias("node", "sheet"))
    there = F.array_contains("sheets", F.col("sheet"))
    head = F.get(F.filter("heads", lambda h: h["sheet"] == F.col("sheet")), F.lit(0))
    mapped = good.filter(there).select("file", "study_id", "provenance", "node", "sheet", head["cells"].alias("head")) \
        .filter(F.size("head") > 0)
    body = rows.filter(F.col("row") >= FIRST_DATA_ROW).select("file", "sheet", "row", F.map_from_entries("cells").alias("at"))
    columns, headers = F.col("head")["col"], F.col("head")["text"]
    texts = F.transform(columns, lambda c: F.coalesce(F.element_at("at", c), F.lit("")))
    # a row without any text under a header is no data. The inline of one
    # element makes the map once a row, whatever reads it afterwards.
    data = body.join(mapped, ["file", "sheet"]).filter(F.exists(columns, lambda c: F.coalesce(F.element_at("at", c) != "", F.lit(False)))) \
        .select("file", "study_id", "node", "sheet", "row", "provenance",
                F.inline(F.array(F.struct(headers.alias("headers"), F.map_from_arrays(headers, texts).alias("cells")))))
    null, empty = F.lit(None), {}
    for name in ("row bigint", "headers array<string>", "cells map<string,string>", "provenance map<string,string>"):
        column, dtype = name.split()
        empty[column] = null.cast(dtype)
    missing = F.concat(F.lit(f"'{META_SHEET}' maps node '"), F.col("node"), F.lit("' to missing sheet '"), F.col("sheet"), F.lit("'"))
    warned = good.filter(~there).withColumns({**empty, "error": missing, "severity": F.lit("warn")})
    failed = books.filter(F.col("error").isNotNull()) \
        .withColumns({**empty, "node": null.cast("string"), "sheet": null.cast("string"), "severity": F.lit("error")})
    return data.withColumns({"error": null.cast("string"), "severity": null.cast("string")}).select(LANDING_COLUMNS) \
        .unionByName(warned.select(LANDING_COLUMNS)).unionByName(failed.select(LANDING_COLUMNS))


def _written(files: DataFrame) -> tuple[DataFrame, str]:
    """The rows of all sheets, unpacked and written once, heads apart."""
    return written_at(sheet_rows(stored_cells(files)), "workbooks", "part")


def land_contents(files: DataFrame, all_sheets: bool = False) -> DataFrame:
    """Landing rows of ``path, study_id, content`` (from a ``binaryFile`` scan
    or any other source of workbook bytes). The sheets' rows stay in the
    scratch space, as the result reads them; ``landing`` removes them."""
    return land(_written(files)[0], all_sheets)


@contextmanager
def landing(files: DataFrame, all_sheets: bool = False) -> Iterator[DataFrame]:
    """``land_contents`` for the length of a block."""
    rows, path = _written(files)
    try:
        yield land(rows, all_sheets)
    finally:
        remove_path(files.sparkSession, path)


def read_workbooks(spark: SparkSession, root: str, prefix: str = DEFAULT_PREFIX, study: str | None = None,
                   all_sheets: bool = False) -> DataFrame:
    """S2-S4 (S7 with ``all_sheets``): every workbook under ``root/prefix`` as
    landing rows."""
    return land_contents(workbook_contents(spark, root, prefix, study), all_sheets)
