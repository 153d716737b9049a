import os

import pytest
from pyspark.sql import functions as F

from deposits import build_workbook, meta_rows
from strata import jobs
from strata.functions.cells import cell_text
from strata.sources import xlsx
from strata.sources.workbook import land_contents, list_workbooks, read_workbooks

META = {"g3mt_version": "0.4.2", "schema_file": "s.json", "target_node": "subject", "path": "p"}


def _write(root, rel, sheets):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(build_workbook(sheets))
    return path


def _good(root, rel="submissions/studyA/wb1.xlsx"):
    subject = [["submitter_id", "Age", "", "flag", "visit_date", "Sub.ID"],
               ["string - required", "integer", "", "boolean", "date", "hint"],
               ["s1", 42, "dropped", True, ("date", 45306), "x"],
               [None, None, None, None, None, None],
               ["  s2 ", 1.5, "dropped", False, ("date", 45306.5), None],
               ["", "   ", "", None, None, None]]
    return _write(root, rel, {"_g3mt": meta_rows(META, {"subject": "Subject", "visit": "Visit", "ghost": "Nope"}),
                              "Subject": subject,
                              "Visit": [["visit_id"], ["hint"], [None], [None]],
                              "Instructions": [["ignore me"]]})


@pytest.fixture()
def deposits(tmp_dir):
    _good(tmp_dir)
    _write(tmp_dir, "submissions/studyA/nometa.XLSX", {"Subject": [["a"], ["h"], ["1"]]})
    _write(tmp_dir, "submissions/studyB/emptymap.xlsx", {"_g3mt": meta_rows(META, {}), "S": [["a"]]})
    _write(tmp_dir, "submissions/studyB/dup.xlsx", {"_g3mt": meta_rows(META, {"subject": "S"}),
                                                     "S": [["a", "a"], ["h", "h"], ["1", "2"]]})
    _write(tmp_dir, "submissions/studyB/~$lock.xlsx", {"S": [["a"]]})
    _write(tmp_dir, "submissions/rootfile.xlsx", {"_g3mt": meta_rows(META, {"subject": "S"}),
                                                  "S": [["Submitter ID", "submitter_id"], ["h", "h"], ["r1", "r2"]]})
    return tmp_dir


def test_listing_filters_and_studies(spark, deposits):
    got = {os.path.basename(r.path): r.study_id for r in list_workbooks(spark, "file://" + deposits).collect()}
    assert got == {"wb1.xlsx": "studyA", "nometa.XLSX": "studyA", "emptymap.xlsx": "studyB", "dup.xlsx": "studyB",
                   "rootfile.xlsx": "unassigned"}
    only_b = list_workbooks(spark, "file://" + deposits, study="studyB").count()
    assert only_b == 2


def test_landing_rows_cells_and_findings(spark, deposits):
    landed = read_workbooks(spark, "file://" + deposits)
    data, findings = landed.filter(F.col("error").isNull()), landed.filter(F.col("error").isNotNull())
    rows = {(os.path.basename(r.file), r.row): r for r in data.collect()}
    r3 = rows[("wb1.xlsx", 3)]
    assert r3.headers == ["submitter_id", "Age", "flag", "visit_date", "Sub.ID"]
    assert r3.cells == {"submitter_id": "s1", "Age": "42", "flag": "True", "visit_date": "2024-01-15 00:00:00",
                        "Sub.ID": "x"}
    r5 = rows[("wb1.xlsx", 5)]
    assert r5.cells["submitter_id"] == "s2" and r5.cells["Age"] == "1.5" and r5.cells["Sub.ID"] == ""
    assert r5.cells["visit_date"] == "2024-01-15 12:00:00" and r5.cells["flag"] == "False"
    assert ("wb1.xlsx", 4) not in rows and ("wb1.xlsx", 6) not in rows  # blank rows
    assert r3.provenance["g3mt_version"] == "0.4.2" and r3.node == "subject"
    assert not any(r.node == "visit" for r in data.collect())  # unfilled sheet: no rows
    assert rows[("rootfile.xlsx", 3)].study_id == "unassigned"
    f = {(os.path.basename(r.file), r.severity): r.error for r in findings.collect()}
    assert "'_g3mt' is missing" in f[("nometa.XLSX", "error")]
    assert "maps no node" in f[("emptymap.xlsx", "error")]
    assert "headers repeat" in f[("dup.xlsx", "error")]
    assert "missing sheet 'Nope'" in f[("wb1.xlsx", "warn")]


def test_cell_texts(spark):
    """Kind, format and stored text -> the text of the typed value."""
    cases = [("text", None, None, " a ", " a "), ("number", 0, None, "42", "42"), ("number", 0, None, "1e-05", "1e-05"),
             ("bool", None, None, "1", "True"), ("bool", None, None, "0", "False"),
             ("number", 14, None, "45306", "2024-01-15 00:00:00"), ("number", 22, None, "45306.5", "2024-01-15 12:00:00"),
             ("number", 14, None, "1", "1900-01-01 00:00:00"), ("number", 14, None, "61", "1900-03-01 00:00:00"),
             ("number", 21, None, "0.5", "12:00:00"), ("number", 21, None, "0.500000011574", "12:00:00.001000"),
             ("number", 14, None, "45306.9999999999", "2024-01-16 00:00:00"), ("number", 14, None, "2958465", "9999-12-31 00:00:00"),
             ("number", 14, None, "1e+300", "1e+300"), ("number", 14, None, "2958466", "2958466"),
             ("number", 164, "yyyy\\-mm", "45306", "2024-01-15 00:00:00"), ("number", 164, "0.0\"days\"", "1.5", "1.5"),
             ("number", 164, "[Red]0.0", "1.5", "1.5"), ("number", 164, "General", "7", "7"),
             ("number", 46, None, "1.5", "1 day, 12:00:00"), ("number", 164, "[h]:mm:ss", "0.25", "6:00:00"),
             ("number", 46, None, "-0.25", "-1 day, 18:00:00"), ("number", 46, None, "2", "2 days, 0:00:00"),
             ("number", 164, "[Red]h:mm", "0.25", "06:00:00"),
             ("iso", None, None, "2024-01-15T10:11:12.5Z", "2024-01-15 10:11:12.500000"), ("iso", None, None, "2024-01-15", "2024-01-15 00:00:00"),
             ("iso", None, None, "soon", "soon")]
    rows = [(i, (1, *c[:4])) for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, c struct<col:int,kind:string,format:int,code:string,value:string>")
    got = [r.t for r in df.select("i", cell_text(F.col("c"), F.lit(False)).alias("t")).orderBy("i").collect()]
    assert got == [c[4] for c in cases]
    late = df.limit(1).select(cell_text(F.struct(F.lit("number").alias("kind"), F.lit(14).alias("format"),
                                                 F.lit(None).cast("string").alias("code"), F.lit("40000").alias("value")), F.lit(True)))
    assert late.first()[0] == "2013-07-07 00:00:00"


def _package(parts):
    import io
    import zipfile
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def _one_sheet(sheet, strings="", styles=""):
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    return _package({
        "xl/workbook.xml": f'<workbook {_MAIN} xmlns:r="{rel}"><workbookPr date1904="1"/><sheets>'
                           '<sheet name="S" r:id="r1"/><sheet name="Gone" r:id="r2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                                      '<Relationship Id="r1" Target="/xl/worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f"<worksheet {_MAIN}><sheetData>{sheet}</sheetData></worksheet>",
        "xl/sharedStrings.xml": f"<sst {_MAIN}>{strings}</sst>", "xl/styles.xml": f"<styleSheet {_MAIN}>{styles}</styleSheet>"})


def test_stored_rows_of_a_package():
    sheet = ('<row><c t="s"><v>0</v></c><c/><c t="s"><v>1</v></c></row><row r="4"><c r="AA4" s="1"><v>1.50</v></c>'
             '<c t="b"><v>1</v></c><c t="str"><f>x</f><v>y</v></c><c t="e"><v>#N/A</v></c></row><row r="5"><c r="A5"/></row>')
    strings = '<si><t>a</t></si><si><r><t>b</t></r><rPh sb="0" eb="1"><t>no</t></rPh><r><t>c</t></r></si>'
    styles = '<numFmts><numFmt numFmtId="164" formatCode="[h]"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs>'
    got = list(xlsx.stored_rows(_one_sheet(sheet, strings, styles)))
    text = lambda c, v: (c, "text", None, None, v)
    assert got == [("S", None, True, []), ("S", 1, True, [text(1, "a"), text(3, "bc")]),
                   ("S", 4, True, [(27, "number", 164, "[h]", "1.5"), (28, "bool", None, None, "1"), text(29, "y"), text(30, "#N/A")])]
    with pytest.raises(ValueError, match="row 1 after row 2"):
        list(xlsx.stored_rows(_one_sheet('<row r="2"/><row r="1"/>')))


def test_a_workbook_that_breaks_half_way_lands_nothing(spark):
    """Nor does one without content, or with no map; odd maps have a result."""
    good = {"S": [["a"], ["h"], ["1"], ["2"]], "T": [["b"], ["h"], ["3"]]}
    files = {
        "no": None, "empty": b"", "part": build_workbook({"_g3mt": meta_rows(META, {"n": "S"}), **good})[:300],
        "broken": _one_sheet('<row r="1"><c t="s"><v>9</v></c></row>'),
        "twice": build_workbook({"_g3mt": [["path", "p1"], ["path", "p2"], ["node", "sheet"], ["n", "S"], ["n", "T"], ["m", "T"], ["", "S"]], **good}),
        "early": build_workbook({"_g3mt": [["node", "sheet"], ["node", "sheet"], ["n", "S"]], **good}),
        "unmapped": build_workbook({"_g3mt": [["path", "p"]], **good}),
        "bare": build_workbook({"_g3mt": meta_rows(META, {"n": "S"}), "S": [[None], [None], ["x"]]})}
    df = spark.createDataFrame([(k, "s", v) for k, v in files.items()], "path string, study_id string, content binary")
    landed = land_contents(df)
    got = landed.filter("error is null").select("file", "node", "sheet", "row", "cells", "provenance").collect()
    assert sorted((r.file, r.node, r.sheet, r.row, tuple(r.cells.items())) for r in got) == [
        ("early", "n", "S", 3, (("a", "1"),)), ("early", "n", "S", 4, (("a", "2"),)),
        ("twice", "", "S", 3, (("a", "1"),)), ("twice", "", "S", 4, (("a", "2"),)),
        ("twice", "m", "T", 3, (("b", "3"),)), ("twice", "n", "T", 3, (("b", "3"),))]
    assert {(r.file, r.provenance.get("path")) for r in got} == {("early", None), ("twice", "p2")}
    bad = {r.file: r.error for r in landed.filter("severity = 'error'").collect()}
    assert set(bad) == {"no", "empty", "part", "broken", "unmapped"} and "maps no node" in bad["unmapped"]
    assert land_contents(df.limit(0)).count() == 0


def test_ingest_job_writes_good_tables_then_raises(spark, deposits, tmp_dir):
    bronze_root = os.path.join(tmp_dir, "bronze")
    with pytest.raises(Exception) as err:
        jobs.ingest(spark, "file://" + deposits, "file://" + bronze_root, batch_marker="run-1")
    assert "nometa.XLSX" in str(err.value) and "dup.xlsx" in str(err.value)
    found = {(os.path.basename(r.file or ""), r.severity) for r in spark.read.parquet(bronze_root + "-findings").collect()}
    assert {("nometa.XLSX", "error"), ("dup.xlsx", "error"), ("wb1.xlsx", "warn"), ("", "info")} <= found
    import glob
    from strata.session import scratch_path
    assert not glob.glob(scratch_path(spark, "landing").removeprefix("file:") + "/*")  # staging is removed
    with pytest.raises(Exception):
        jobs.ingest(spark, "file://" + deposits, "file://" + tmp_dir + "/dry", dry_run=True)
    rep = jobs.ingest(spark, "file://" + deposits, "file://" + tmp_dir + "/dry", dry_run=True, study="unassigned").collect()
    assert [(r.table_name, r.n_rows, "submitter_id_2" in r.columns) for r in rep] == [("bronze_unassigned_subject", 1, True)]
    assert not os.path.exists(tmp_dir + "/dry") and not os.path.exists(tmp_dir + "/dry-findings")
    t = spark.read.parquet(os.path.join(bronze_root, "bronze_studya_subject"))
    assert t.count() == 2
    assert {"submitter_id", "age", "flag", "visit_date", "sub_id", "row_hash", "_src_batch_id"} <= set(t.columns)
    assert t.select("_src_batch_id").distinct().first()[0] == "run-1"
    from strata.sinks import writers
    u = writers.read_bronze(spark, os.path.join(bronze_root, "bronze_unassigned_subject"))
    assert sorted(u.columns)[:2] == ["_src_batch_id", "_src_file"] and "submitter_id_2" in u.columns


def test_all_sheets_mode_and_dry_run(spark, deposits, tmp_dir):
    from strata.sources.workbook import read_workbooks
    landed = read_workbooks(spark, "file://" + deposits, study="studyA", all_sheets=True) \
        .filter(F.col("error").isNull())
    sheets = {r.sheet for r in landed.select("sheet").distinct().collect()}
    assert {"Subject", "_g3mt"} <= sheets  # every sheet, name kept as a column
    data = read_workbooks(spark, "file://" + deposits, study="unassigned").filter(F.col("error").isNull())
    from strata.operators import landing
    cells = landing.bronze_from_cells(data, batch_id="b", ingested_at="t")
    rep = {r.table_name: r.n_rows for r in landing.dry_run_report(cells).collect()}
    assert rep == {"bronze_unassigned_subject": 1}
    assert not os.path.exists(tmp_dir + "/nothing")


def test_dry_run_reports_what_an_ingest_writes(spark, tmp_dir):
    """A row counts once however often its workbook is listed; the columns are
    those of all workbooks of a table, named as they are written."""
    from strata.operators import landing
    from strata.sinks import writers
    a = [["ID", "Age"], ["h", "h"], ["1", "2"], ["1", "2"]]
    b = [["id", "Sub.ID", "ID", "row_hash"], ["h"] * 4, ["1", "x", "3", "y"]]
    books = {f"submissions/st/{k}.xlsx": {"_g3mt": meta_rows(META, {"n": "S", "m": "T"}), "S": s, "T": t}
             for k, s, t in (("a", a, [["only"], ["h"], ["v"]]), ("b", b, [["blank"], ["h"]]))}
    rows = [(_write(tmp_dir, path, sheets), "st", build_workbook(sheets)) for path, sheets in books.items()]
    df = spark.createDataFrame([*rows, rows[0]], "path string, study_id string, content binary")
    cells = landing.bronze_from_cells(land_contents(df).filter("error is null"), batch_id="b", ingested_at="t")
    assert cells.count() == 7
    rep = {r.table_name: r for r in landing.dry_run_report(cells).collect()}
    assert {t: (r.n_rows, r.n_columns) for t, r in rep.items()} == {"bronze_st_n": (3, 15), "bronze_st_m": (1, 11)}
    assert rep["bronze_st_n"].columns == ["age", "id", "id_2", "row_hash_2", "sub_id", *landing.PROVENANCE_COLUMNS]
    jobs.ingest(spark, "file://" + tmp_dir, f"file://{tmp_dir}/bronze", batch_marker="b")
    for name, r in rep.items():
        written = writers.read_bronze(spark, f"{tmp_dir}/bronze/{name}")
        assert written.count() == r.n_rows and sorted(written.columns) == sorted(r.columns)


def test_workbooks_are_zipped_by_the_hundred(spark, tmp_dir):
    from strata.plans.workbooks import customer_workbooks
    from strata.sources.workbook import land_contents
    spark.createDataFrame([(i, f"a<&{i}", 1.5, "BUILDING", i % 3) for i in range(30)],
                          "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string, c_nationkey int") \
        .write.parquet(f"{tmp_dir}/zipped/customer.parquet")
    books = customer_workbooks(spark, f"{tmp_dir}/zipped")
    plan = books._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    landed = land_contents(books).where("error IS NULL").collect()
    assert sorted(r.cells["c_name"] for r in landed) == sorted(f"a<&{i}" for i in range(30))
