import os

from strata.sinks import writers
from deposits import build_workbook, meta_rows
from strata.streaming.landing import compact_silver, landing_failures, read_silver, start_record_landing, start_workbook_landing

META = {"g3mt_version": "1", "schema_file": "s", "target_node": "subject"}


def _wb(root, rel, rows):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as fh:
        fh.write(build_workbook({"_g3mt": meta_rows(META, {"subject": "S"}), "S": rows}))


def test_incremental_landing_sees_only_new_files_and_promotes_newest(spark, tmp_dir):
    dep, bronze, silver = tmp_dir + "/dep", tmp_dir + "/bronze", tmp_dir + "/silver"
    ckpt = tmp_dir + "/ckpt"
    _wb(dep, "submissions/s1/a.xlsx", [["id", "v"], ["h", "h"], ["1", "x"], ["2", "y"]])
    q = start_workbook_landing(spark, "file://" + dep, "file://" + bronze, "run1", "2024-01-01T00:00:00+00:00",
                               silver_path="file://" + silver, checkpoint="file://" + ckpt)
    q.awaitTermination()
    first = spark.read.parquet(bronze + "/bronze_s1_subject")
    assert first.count() == 2
    _wb(dep, "submissions/s1/b.xlsx", [["id", "v"], ["h", "h"], ["3", "z"]])
    q = start_workbook_landing(spark, "file://" + dep, "file://" + bronze, "run2", "2024-02-01T00:00:00+00:00",
                               silver_path="file://" + silver, checkpoint="file://" + ckpt)
    q.awaitTermination()
    b = spark.read.parquet(bronze + "/bronze_s1_subject")
    assert b.count() == 3  # a.xlsx was not landed again
    batches = sorted(r[0] for r in b.select("_src_batch_id").distinct().collect())
    assert batches[0].startswith("run1-") and batches[1].startswith("run2-")
    assert {"id", "v", "row_hash", "_src_file"} <= set(b.columns)  # same wide bronze table as batch ingest
    s = read_silver(spark, silver + "/silver_s1_subject")
    assert s.count() == 3 and s.select("row_hash").distinct().count() == 3
    compact_silver(spark, silver + "/silver_s1_subject", tmp_dir + "/compact")
    assert sorted(map(tuple, read_silver(spark, tmp_dir + "/compact").select("row_hash", "id").collect())) == \
        sorted(map(tuple, s.select("row_hash", "id").collect()))


def test_a_bad_workbook_is_a_finding_and_the_good_one_lands(spark, tmp_dir):
    dep, bronze = tmp_dir + "/submissions/dep", tmp_dir + "/bronze"  # the prefix also stands above the root
    _wb(dep, "submissions/s1/a.xlsx", [["id"], ["h"], ["1"]])
    with open(dep + "/submissions/s1/torn.xlsx", "wb") as fh:
        fh.write(b"PK torn")
    q = start_workbook_landing(spark, "file://" + dep, "file://" + bronze, "run", "t", checkpoint="file://" + tmp_dir + "/c")
    q.awaitTermination()
    assert spark.read.parquet(bronze + "/bronze_s1_subject").count() == 1
    bad = landing_failures(spark, bronze + "-findings", "run").collect()
    assert [(r.file.rsplit("/", 1)[-1], r.study_id) for r in bad] == [("torn.xlsx", "s1")]


def test_a_small_batch_adds_files_and_rewrites_none(spark, tmp_dir):
    import glob
    from strata.streaming.landing import promote_batch
    def rows(n, at):
        return spark.range(n).selectExpr("cast(id as string) as k", "sha2(cast(id as string), 256) as row_hash",
                                         f"'{at}' as _src_batch_id", f"'{at}' as _src_ingested_at", "'f' as _src_file",
                                         "'s' as _src_sheet", "'1' as _src_row")
    promote_batch(rows(2000, "t1"), tmp_dir + "/silver", run_key="e1")
    before = set(glob.glob(tmp_dir + "/silver/**/*.parquet", recursive=True))
    promote_batch(rows(600, "t2"), tmp_dir + "/silver", run_key="e2")
    promote_batch(rows(600, "t2"), tmp_dir + "/silver", run_key="e2")  # a replayed epoch
    assert before <= set(glob.glob(tmp_dir + "/silver/**/*.parquet", recursive=True))
    got = read_silver(spark, tmp_dir + "/silver")
    assert got.count() == 2000 and got.filter("_src_batch_id = 't2'").count() == 600


def test_record_landing_takes_new_lines_and_reports_bad_ones(spark, tmp_dir):
    import pathlib
    root = pathlib.Path(tmp_dir) / "dep"
    (root / "submissions/s1/subject").mkdir(parents=True)
    lines = ['{"a": "x", "b": 1}', "", '{"a": null, "c": {"d": [true]}}', "[1]", '{"a": "x", "b": 1}', "{"]
    (root / "submissions/s1/subject/one.jsonl").write_text("\n".join(lines))
    (root / "submissions/s1/loose.jsonl").write_text('{"a": "y"}\n')
    bronze, seen = tmp_dir + "/bronze", "file://" + tmp_dir + "/seen"

    def land(run):
        start_record_landing(spark, "file://" + str(root), "file://" + bronze, run, "t", silver_path="file://" + tmp_dir + "/silver",
                             checkpoint=seen).awaitTermination()
        return sorted((r.file.rsplit("/", 1)[-1], r.error) for r in landing_failures(spark, bronze + "-findings", run).collect())
    assert land("r1") == [("loose.jsonl", "no study and node folder"), ("one.jsonl", "not a JSON object"), ("one.jsonl", "not valid JSON")]
    table = writers.read_bronze(spark, bronze + "/bronze_s1_subject")
    got = sorted((int(r._src_row), r.a, r.b, r.c) for r in table.collect())
    assert got == [(1, "x", "1", None), (3, "", None, '{"d":[true]}'), (5, "x", "1", None)]
    (root / "submissions/s1/subject/two.jsonl").write_text('{"a": "new"}\n')
    assert land("r2") == []
    table = writers.read_bronze(spark, bronze + "/bronze_s1_subject")
    assert [(int(r._src_row), r.a) for r in table.where("_src_batch_id like 'r2-%'").collect()] == [(1, "new")]
    assert read_silver(spark, tmp_dir + "/silver/silver_s1_subject").count() == 4
