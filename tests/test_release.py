import os

from pyspark.sql import functions as F

from strata import jobs
from strata.operators import release
from strata.sources.dictionary import links_frame
from strata.sources.files import list_validation_artifacts
from strata.sinks import writers


def _ledger(spark, rows):
    return spark.createDataFrame(rows, "release_tag string, db_name string, model_name string, snapshot_id long, "
                                       "github_sha string")


def test_latest_and_previous_release(spark):
    led = _ledger(spark, [(t, "g_gold_db", "gold_a_t", 1, "s") for t in
                          ["1.2.9", "1.10.0rc1", "1.10.0", "1.2", "v9.0"]])
    assert release.latest_release(led).first()[0] == "1.10.0"
    assert release.previous_release(led).first()[0] == "1.10.0rc1"
    assert release.latest_release(led, override="1.2").first()[0] == "1.2"


def test_release_rows_and_idempotent_ledger(spark):
    existing = _ledger(spark, [("1.0", "p_gold_db", "gold_a_x", 1, "s")])
    push = _ledger(spark, [("1.0", "p_gold_db", "gold_a_x", 1, "s"), ("1.0", "p_gold_db", "gold_a_y", 2, "s"),
                           ("1.0", "ci_p_gold_db", "gold_a_z", 3, "s"), ("1.0", "p_silver_db", "silver_a_x", 4, "s")])
    todo = release.append_ledger_rows(existing, push).collect()
    assert sorted(r.model_name for r in todo) == ["gold_a_y", "silver_a_x"]
    rows = release.release_rows(existing.unionByName(push), "1.0").select("model_name").distinct().collect()
    assert sorted(r[0] for r in rows) == ["gold_a_x", "gold_a_y", "gold_a_z"]  # F7 alone keeps ci_ (F10 is the writer's)


def test_import_order_diamond_and_cycle(spark):
    diamond = links_frame(spark, [("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "d"), ("e", "a")])
    got = {r.node: (r.level, r.pos, r.cycle) for r in release.import_order(spark, diamond).collect()}
    assert got["a"] == (0, 0, False) and got["d"][0] == 2 and got["e"][0] == 3
    edges = [("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "d"), ("e", "a")]
    for child, parent in edges:  # every edge goes forward
        assert got[parent][1] < got[child][1]
    cyc = links_frame(spark, [("b", "a"), ("c", "b"), ("b", "c"), ("y", "x"), ("x", "y")])
    got = {r.node: (r.level, r.cycle) for r in release.import_order(spark, cyc).collect()}
    assert got["a"] == (0, False)
    assert got["b"][1] and got["c"][1] and got["x"][1] and got["y"][1]


def test_read_at_pins_and_latest(spark):
    t = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 12)], "k int, snapshot_id long")
    assert release.read_at(t, 11).count() == 1
    assert release.read_at(t, 11, cumulative=True).count() == 3
    assert [r.k for r in release.read_latest(t).collect()] == [4]


def test_export_release_job(spark, tmp_dir):
    led = _ledger(spark, [("1.0", "p_gold_db", "gold_a_subject", 1, "s"),
                          ("1.1", "p_gold_db", "gold_a_subject", 2, "s"),
                          ("1.1", "p_gold_db", "gold_staging_b_sample_x", 1, "s")])
    table = spark.createDataFrame([("s1", 1), ("s2", 2), ("s3", 2)], "submitter_id string, snapshot_id long")
    order = release.import_order(spark, links_frame(spark, [("sample_x", "subject")]))
    models = jobs.export_release(spark, led, lambda db, m: table, "file://" + tmp_dir, order)
    assert models.count() == 2
    out = spark.read.text(os.path.join(tmp_dir, "release_jsons"))
    got = {(r.release_dir, r.study_id, r.write_table, r.value) for r in out.collect() if r.release_dir}
    assert ("v1.1", "a", "subject", '{"submitter_id":"s2"}') in got
    assert ("v1.1", "staging/b", "sample_x", '{"submitter_id":"s1"}') in got
    io = spark.read.text(os.path.join(tmp_dir, "release_import_order"), wholetext=True).collect()
    assert {r.value.strip() for r in io} == {"subject\nsample_x"} and len(io) == 2  # one file per study


def test_dump_and_list_artifacts_keep_leading_zeros(spark, tmp_dir):
    recs = spark.createDataFrame([("a", "0042", "silver_a_subject", "007", "s1", 1)],
                                 "study_id string, validation_id string, table_name string, snapshot_id string, "
                                 "submitter_id string, age int")
    writers.dump_json(recs, "file://" + tmp_dir + "/validation")
    arts = list_validation_artifacts(spark, "file://" + tmp_dir + "/validation").collect()
    assert [(r.study_id, r.validation_id, r.snapshot_id) for r in arts] == [("a", "0042", "007")]
    text = spark.read.text(tmp_dir + "/validation").first().value
    assert text == '{"submitter_id":"s1","age":1}'


def test_tolerant_csv_sniffs_delimiters(spark, tmp_dir):
    from strata.sources.files import read_csv_tolerant
    with open(os.path.join(tmp_dir, "a.csv"), "w") as fh:
        fh.write("x;y\n1;2\n3;4;5\n")
    with open(os.path.join(tmp_dir, "b.csv"), "w") as fh:
        fh.write("x,z\n7,8\n")
    df = read_csv_tolerant(spark, [os.path.join(tmp_dir, "a.csv"), os.path.join(tmp_dir, "b.csv")])
    rows = df.collect()
    assert {(r.x, r.y, r.z, r._corrupt_record) for r in rows} == \
        {("1", "2", None, None), ("3", "4", None, "3;4;5"), ("7", None, "8", None)}


def test_tolerant_csv_reads_each_header_order(spark, tmp_dir):
    from strata.sources.files import read_csv_tolerant
    texts = {"a.csv": b"id,age\n1,30\n", "b.csv": b"age,id\n50,3\n", "c.csv": b"", "d.csv": b"\xef\xbb\xbfid,age,age\r\n\"4,5\",6,7\r\n",
             "e.csv": "id|n|name, noted\n8|y|na\u00efve\n".encode("latin-1")}
    for name, data in texts.items():
        with open(os.path.join(tmp_dir, name), "wb") as fh:
            fh.write(data)
    rows = read_csv_tolerant(spark, [tmp_dir]).collect()
    assert {(r.id, r.age, r.age_2, r["name, noted"], r._corrupt_record) for r in rows} == {
        ("1", "30", None, None, None), ("3", "50", None, None, None), ("4,5", "6", "7", None, None), ("8", None, None, "na\u00efve", None)}
    assert read_csv_tolerant(spark, [os.path.join(tmp_dir, "c.csv")]).count() == 0


def test_results_sinks(spark, tmp_dir):
    from strata.operators import checks
    res = checks.error_row(spark, "st", OSError("x"), validation_id="v1", schema_version="1")
    writers.append_results(res, tmp_dir + "/results")
    writers.append_results(res, tmp_dir + "/results")  # a retried run replaces its own partition
    assert spark.read.parquet(tmp_dir + "/results").count() == 1
    res2 = checks.error_row(spark, "st", OSError("y"), validation_id="v2", schema_version="1")
    writers.append_results(res2, tmp_dir + "/results")  # a new run appends
    assert spark.read.parquet(tmp_dir + "/results").count() == 2
    for text in ("first", "second"):  # runs whose id is unknown do not erase each other
        writers.append_results(checks.error_row(spark, "st", OSError(text), validation_id=None, schema_version="1"),
                               tmp_dir + "/results")
    assert writers.read_results(spark, tmp_dir + "/results").filter("validation_id is null").count() == 2
    bronze = spark.createDataFrame([("h1", "b1")], "row_hash string, _src_batch_id string")
    for run in (None, None, "r", "r"):  # appends under one marker add up; a retried run replaces itself
        writers.append_bronze(bronze, tmp_dir + "/bronze", run_key=run)
    assert writers.read_bronze(spark, tmp_dir + "/bronze").count() == 3
    order = release.import_order(spark, links_frame(spark, [("sample", "subject")]))
    for tag, studies in (("v1.0", ["a", "b"]), ("v1.1", ["b"])):
        writers.write_import_order(order, spark.createDataFrame([(tag, s) for s in studies], "release_dir string, study_id string"),
                                   tmp_dir + "/order")
    got = {(r.release_dir, r.study_id) for r in spark.read.text(tmp_dir + "/order").collect()}
    assert got == {("v1.0", "a"), ("v1.0", "b"), ("v1.1", "b")}
    snap = spark.createDataFrame([(1,)], "k int")
    writers.write_snapshot(snap, tmp_dir + "/snap", 7)
    writers.write_snapshot(snap, tmp_dir + "/snap", 8)
    writers.write_snapshot(snap, tmp_dir + "/snap", 8)
    assert spark.read.parquet(tmp_dir + "/snap").count() == 2
    writers.results_csv(res, tmp_dir + "/csv")
    assert spark.read.option("header", True).csv(tmp_dir + "/csv").first().study_id == "st"
    assert F is not None


def test_small_release_helpers(spark):
    from strata.functions.text import release_tag_from_git
    from strata.operators import gate
    df = spark.createDataFrame([("data-v0.1.0",), ("1.2",)], "t string")
    assert [r[0] for r in df.select(release_tag_from_git("t")).collect()] == ["0.1.0", "1.2"]
    listing = spark.createDataFrame([("ci_p_gold_db", "gold_a_x"), ("p_gold_db", "gold_a_x"), ("p_gold_db", "gold_b_y")],
                                    "db_name string, table_name string")
    models = spark.createDataFrame([("gold_a_x",), ("gold_c_z",)], "model_name string")
    got = {r.model_name: r.db_name for r in release.resolve_model_db(listing, models).collect()}
    assert got == {"gold_a_x": "p_gold_db", "gold_c_z": None}
    snaps = spark.createDataFrame([("t1", 1), ("t1", 5), ("t2", 3)], "table_name string, snapshot_id long")
    assert {r.table_name: r.snapshot_id for r in release.latest_snapshots(snaps).collect()} == {"t1": 5, "t2": 3}
    arts = spark.createDataFrame([("a", "v1"), ("b", "v2"), ("a", "v2")], "study_id string, validation_id string")
    assert sorted(r[0] for r in gate.run_studies(arts, "v2").collect()) == ["a", "b"]
    assert {r.study_id: r.validation_id for r in gate.latest_validation_per_study(arts).collect()} == \
        {"a": "v2", "b": "v2"}


def test_tag_manifest_filter(spark):
    from strata.sources.files import tagged_files
    listing = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "path string")
    manifest = spark.createDataFrame([("p1", "ingest", "true"), ("p2", "ingest", "false"), ("p3", "other", "true")],
                                     "path string, tag string, value string")
    assert [r.path for r in tagged_files(listing, manifest).collect()] == ["p1"]


def test_dump_keeps_null_fields(spark, tmp_dir):
    recs = spark.createDataFrame([("a", "1", "t", "1", "s1", None)],
                                 "study_id string, validation_id string, table_name string, snapshot_id string, "
                                 "submitter_id string, age int")
    writers.dump_json(recs, "file://" + tmp_dir + "/v")
    assert spark.read.text(tmp_dir + "/v").first().value == '{"submitter_id":"s1","age":null}'


def test_export_release_names_models_with_an_empty_pin(spark, tmp_dir):
    import pytest
    led = _ledger(spark, [("2.0", "p_gold_db", "gold_a_subject", 2, "s"),
                          ("2.0", "p_gold_db", "gold_a_sample", 99, "s")])
    table = spark.createDataFrame([("s1", 1), ("s2", 2)], "submitter_id string, snapshot_id long")
    order = release.import_order(spark, links_frame(spark, [("sample", "subject")]))
    with pytest.raises(writers.PartialFailure) as err:
        jobs.export_release(spark, led, lambda db, m: table, "file://" + tmp_dir, order)
    assert "gold_a_sample@99" in str(err.value) and "gold_a_subject" not in str(err.value)
    out = spark.read.text(os.path.join(tmp_dir, "release_jsons")).collect()
    assert [(r.write_table, r.value) for r in out] == [("subject", '{"submitter_id":"s2"}')]


def test_export_release_reports_misnamed_models_and_an_empty_ledger(spark, tmp_dir):
    import pytest
    led = _ledger(spark, [("2.0", "p_gold_db", m, 1, "s") for m in ("gold_a_subject", "goldx", "gold_b")])
    table = spark.createDataFrame([("s1", 1)], "submitter_id string, snapshot_id long")
    order = release.import_order(spark, links_frame(spark, [("sample", "subject")]))
    with pytest.raises(writers.PartialFailure) as err:
        jobs.export_release(spark, led, lambda db, m: table, "file://" + tmp_dir, order)
    assert "goldx" in str(err.value) and "gold_b" in str(err.value)
    assert spark.read.text(tmp_dir + "/release_jsons").count() == 1
    assert spark.read.text(tmp_dir + "/release_findings").count() == 2
    with pytest.raises(LookupError):
        jobs.export_release(spark, led.filter("false"), lambda db, m: table, "file://" + tmp_dir + "/none", order)
    silver = _ledger(spark, [("2.0", "p_silver_db", "silver_a_subject", 1, "s")])
    assert jobs.export_release(spark, silver, lambda db, m: table, "file://" + tmp_dir + "/none", order).count() == 0


def test_dump_then_validate_from_the_dump(spark, tmp_dir):
    import pytest
    from strata.sources.dictionary import dictionary_from_obj
    def snap(rows, cols):
        return spark.createDataFrame(rows, cols + ", snapshot_id long")
    held = {"silver_a_subject": snap([("s1", "F", 1), ("s1", "X", 2), ("s2", "F", 2)], "submitter_id string, sex string"),
            "silver_a_sample": snap([("m1", "s1", 5), ("m2", "gone", 5), ("m3", None, 5)], "submitter_id string, subjects string"),
            "silver_b_subject": snap([("t1", "M", 1)], "submitter_id string, sex string")}
    names = spark.createDataFrame([(n,) for n in [*held, "silver_lookup_x", "silver_a_tmp_dbt_tmp", "silver_c_left", "silver"]], "table_name string")
    with pytest.raises(writers.PartialFailure) as err:
        jobs.dump(spark, names, lambda n: held[n], "file://" + tmp_dir, target="ci", exclude=" silver_c_left ,", validation_id="v1")
    assert "'silver'" in str(err.value) and "1 table" in str(err.value)
    records, studies, bad = jobs.read_dump(spark, "file://" + tmp_dir, "v1", target="ci")
    assert bad.count() == 0
    assert sorted(records) == ["sample", "subject"] and sorted(r[0] for r in studies.collect()) == ["a", "b"]
    assert records["subject"].count() == 3  # the latest snapshots alone
    d = dictionary_from_obj(spark, {"subject": {"properties": {"sex": {"enum": ["F", "M"]}}}, "sample": {
        "properties": {"note": {}}, "links": [{"name": "subjects", "target_type": "subject", "required": True}]}})
    with pytest.raises(jobs.GateFailed):
        jobs.validate(spark, records, d, results_path=tmp_dir + "/res", studies=studies, validation_id="v1",
                      custom={"subject": [("no_t", F.col("submitter_id").startswith("t"), F.lit("t is not allowed"))]})
    got = {(r.study_id, r.submitter_id, r.validator, r.validation_result) for r in writers.read_results(spark, tmp_dir + "/res").collect()}
    assert got == {("a", "s1", "enum", "FAIL"), ("a", "m2", "link", "FAIL"), ("a", "m3", "required", "FAIL"), ("b", "t1", "no_t", "FAIL")}


def test_validate_goes_on_past_a_study_that_cannot_be_read(spark, tmp_dir):
    import pytest
    from strata.sources.dictionary import dictionary_from_obj
    d = dictionary_from_obj(spark, {"subject": {"properties": {"x": {"enum": ["ok"]}}}, "visit": {"properties": {"x": {"enum": ["ok"]}}}})
    rows = [("s1", "a", "bad"), ("s2", "b", "ok"), ("s3", "c", "torn")]
    df = spark.createDataFrame(rows, "submitter_id string, study_id string, x string")
    torn = df.withColumn("x", F.when(F.col("x") == "torn", F.raise_error(F.lit("block is missing")).cast("string")).otherwise(F.col("x")))
    with pytest.raises(writers.PartialFailure) as err:
        jobs.validate(spark, {"subject": torn, "visit": df.filter("study_id <> 'c'"), "alien": df.filter("study_id = 'b'")}, d,
                      results_path=tmp_dir + "/res", studies=df.select("study_id"), validation_id="v1")
    assert "c (" in str(err.value)
    got = sorted((r.study_id, r.node, r.validation_result) for r in writers.read_results(spark, tmp_dir + "/res").collect())
    assert [g for g in got if g[0] == "a"] == [("a", "subject", "FAIL"), ("a", "visit", "FAIL")]
    assert [g for g in got if g[0] == "b"] == [("b", "alien", "ERROR")]
    assert [g for g in got if g[0] == "c"] == [("c", None, "ERROR")]


def test_tolerant_json_and_generic_source(spark, tmp_dir):
    from strata.sources.files import read_json_tolerant, read_source
    with open(os.path.join(tmp_dir, "a.json"), "w") as fh:
        fh.write('[{"id": 1, "x": "a"}, {"id": 2, "y": true}]')
    with open(os.path.join(tmp_dir, "b.json"), "w") as fh:
        fh.write('{"id": 3, "x": "c"')  # truncated: kept as a corrupt record
    df = read_json_tolerant(spark, [os.path.join(tmp_dir, "a.json"), os.path.join(tmp_dir, "b.json")])
    rows = df.collect()
    assert sorted(r.id for r in rows if r.id is not None) == [1, 2]
    assert any(r._corrupt_record for r in rows)
    spark.createDataFrame([(1, "p")], "k int, v string").write.parquet(os.path.join(tmp_dir, "pq"))
    assert read_source(spark, "parquet", os.path.join(tmp_dir, "pq")).first().v == "p"


def test_plans_do_not_bring_a_node_together_in_one_task(spark):
    order = release.import_order(spark, spark.createDataFrame([("b", "a")], "child string, parent string"))
    rows = spark.createDataFrame([("b", "2"), ("a", "1"), ("b", "1"), ("z", "0"), (None, "n")], "node string, submitter_id string")
    plans = [release.upload_plan(rows, order), release.delete_plan(rows.withColumnRenamed("submitter_id", "gen3_guid"), order)]
    assert [(r.node, r.submitter_id, r.pos) for r in plans[0].collect()] == [
        ("a", "1", 0), ("b", "1", 1), ("b", "2", 1), ("z", "0", None), (None, "n", None)]
    assert [r.node for r in plans[1].collect()] == ["z", None, "b", "b", "a"]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for p in (release.upload_plan(rows, order), release.delete_plan(rows.withColumnRenamed("submitter_id", "gen3_guid"), order)):
            assert "hashpartitioning" not in p._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
