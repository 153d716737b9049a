"""Catalogue: workbook landing.

Customer rows become workbooks inside Spark (one per nation and key chunk
of at most ``CHUNK`` keys, so no group is unbounded): a row's cells are written
by columns, the parts of a workbook are zipped. The bytes go through the same
reader a ``binaryFile`` scan feeds, and the landed rows are stamped, hashed
over the original headers and renamed to safe columns as a deposit's are.
"""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import BinaryType

from strata.operators import landing
from strata.plans.common import BATCH_A, INGESTED_A, query, table
from strata.sources.workbook import land_contents

CHUNK = 2000
# The deposited sheet layout. The blank fourth header drops its
# column; "c.acctbal" and "Nation #" exercise safe names.
HEADERS = ["c_custkey", "c_name", "c.acctbal", "", "c_mktsegment", "Nation #"]
HINTS = ["integer - required", "string", "number", "", "enum", "integer"]
BLANK_ROWS = 5
META = {"g3mt_version": "0.4.2", "schema_file": "dictionary.json", "target_node": "customer",
        "path": "submissions"}
# Parts of a workbook of two sheets, as its format prescribes.
_NS = "http://schemas.openxmlformats.org"
_REL = f"{_NS}/officeDocument/2006/relationships"
PARTS = {
    "[Content_Types].xml": f'<Types xmlns="{_NS}/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/workbook.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="{_NS}/package/2006/relationships">'
    f'<Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": f'<workbook xmlns="{_NS}/spreadsheetml/2006/main" xmlns:r="{_REL}"><sheets>'
    '<sheet name="_g3mt" sheetId="1" r:id="rId1"/><sheet name="Customer" sheetId="2" r:id="rId2"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_NS}/package/2006/relationships">'
    f'<Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/>'
    f'<Relationship Id="rId2" Type="{_REL}/worksheet" Target="worksheets/sheet2.xml"/></Relationships>',
}


def _cell(value: Column, number: bool = False) -> Column:
    """A cell of the next column: a number, a text in place, or nothing."""
    if number:
        stored = F.concat(F.lit("<c><v>"), value.cast("string"), F.lit("</v></c>"))
    else:
        plain = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        stored = F.concat(F.lit('<c t="inlineStr"><is><t xml:space="preserve">'), plain, F.lit("</t></is></c>"))
    return F.coalesce(stored, F.lit('<c s="0"/>'))


def _row(number: Column, *cells: Column) -> Column:
    return F.concat(F.lit('<row r="'), number.cast("string"), F.lit('">'), *cells, F.lit("</row>"))


def _text_rows(rows: list[list[str]]) -> Column:
    return F.concat(*[_row(F.lit(i), *[_cell(F.lit(v)) for v in row]) for i, row in enumerate(rows, start=1)])


def _sheet(*rows: Column) -> Column:
    return F.concat(F.lit(f'<worksheet xmlns="{_NS}/spreadsheetml/2006/main"><sheetData>'), *rows,
                    F.lit("</sheetData></worksheet>"))


@F.udf(BinaryType(), useArrow=False)
def _zipped(meta: str, data: str) -> bytes:
    """A workbook's bytes. A worker is handed workbooks by the hundred, not by
    Arrow's ten thousand."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, part in (*PARTS.items(), ("xl/worksheets/sheet1.xml", meta), ("xl/worksheets/sheet2.xml", data)):
            z.writestr(name, part)
    return out.getvalue()


def customer_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, study_id, content`` of the deposits."""
    group = ["c_nationkey", "chunk"]
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey") \
        .withColumn("chunk", F.floor(F.col("c_custkey") / CHUNK))
    c = c.withColumn("n", F.row_number().over(Window.partitionBy(*group).orderBy("c_custkey")) + len([HEADERS, HINTS]))
    line = _row(F.col("n"), _cell(F.col("c_custkey"), True), _cell(F.col("c_name")), _cell(F.col("c_acctbal"), True),
                _cell(F.lit("ignored")), _cell(F.col("c_mktsegment")), _cell(F.col("c_nationkey"), True))
    books = c.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("n", line.alias("xml")))).alias("lines"))
    blank = F.transform(F.sequence(F.lit(1), F.lit(BLANK_ROWS)),
                        lambda i: _row(F.element_at("lines", -1)["n"] + i, *[F.lit('<c s="0"/>')] * len(HEADERS)))
    meta = _sheet(_text_rows([[k, v] for k, v in META.items()] + [["node", "sheet"], ["customer", "Customer"]]))
    data = _sheet(_text_rows([HEADERS, HINTS]), F.array_join(F.col("lines")["xml"], ""), F.array_join(blank, ""))
    study = F.concat(F.lit("nation"), F.col("c_nationkey").cast("string"))
    path = F.concat(F.lit("deposits/submissions/"), study, F.lit("/customers_"), F.lpad(F.col("chunk").cast("string"), 5, "0"), F.lit(".xlsx"))
    return books.select(path.alias("path"), study.alias("study_id"), _zipped(meta, data).alias("content"))


_OUT = ["_src_file", "_src_sheet", "_src_row", "_src_study_id", "_src_target_node", "table_name", "row_hash",
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "nation__"]


@query("workbook_landing", f"""
WITH c AS (
  SELECT *, c_custkey // {CHUNK} AS chunk,
         row_number() OVER (PARTITION BY c_nationkey, c_custkey // {CHUNK} ORDER BY c_custkey) + 2 AS r
  FROM customer
), b AS (
  SELECT 'deposits/submissions/nation' || CAST(c_nationkey AS VARCHAR) || '/customers_' ||
           lpad(CAST(chunk AS VARCHAR), 5, '0') || '.xlsx' AS _src_file,
         CAST(r AS VARCHAR) AS _src_row, c.*
  FROM c
)
SELECT _src_file, 'Customer' AS _src_sheet, _src_row, 'nation' || CAST(c_nationkey AS VARCHAR) AS _src_study_id,
       'customer' AS _src_target_node, 'bronze_nation' || CAST(c_nationkey AS VARCHAR) || '_customer' AS table_name,
       sha256(concat_ws('|', 'c_custkey=' || CAST(c_custkey AS VARCHAR), 'c_name=' || c_name,
                        'c.acctbal=' || CAST(c_acctbal AS VARCHAR), 'c_mktsegment=' || c_mktsegment,
                        'Nation #=' || CAST(c_nationkey AS VARCHAR), '_src_file=' || _src_file,
                        '_src_sheet=Customer', '_src_row=' || _src_row)) AS row_hash,
       CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment,
       CAST(c_nationkey AS VARCHAR) AS nation__
FROM b
""")
def workbook_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = land_contents(customer_workbooks(spark, sf_dir))
    data = landed.filter(F.col("error").isNull())
    bronze = landing.bronze_from_cells(data, batch_id=BATCH_A, ingested_at=INGESTED_A)
    wide = bronze.select("table_name", *[F.element_at("safe_cells", F.lit(c)).alias(c)
                                         for c in ("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "nation__")],
                         *landing.PROVENANCE_COLUMNS)
    return wide.select(*_OUT)
