"""Plan-shape checks: the physical plans keep the properties the design
relies on at scale."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df):
    """The final plan: the frame itself is executed, so AQE has finished it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=false" not in plan
    return plan.split("== Initial Plan ==")[0]


def test_newest_per_hash_limits_before_the_shuffle(spark):
    plan = _plan(entry.queries()["dedupe_bronze"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_checks_are_one_pass_without_shuffle(spark):
    for name in ("check_enum", "check_long_form"):
        plan = _plan(entry.queries()[name](spark, SF).filter("node in ('documents', 'conversations')"))
        assert "Generate explode" in plan and "NestedLoop" not in plan
        # The one shuffle is the records' own join of documents and labels.
        assert plan.count("Exchange hash") <= 2, plan


def test_gate_reads_the_latest_run_alone(spark, tmp_dir):
    from strata.operators import checks, gate
    from strata.sinks import writers
    for vid in ("v1", "v2"):
        writers.append_results(checks.error_row(spark, "st", OSError(vid), validation_id=vid, schema_version="1"), tmp_dir + "/r")
    results = writers.read_results(spark, tmp_dir + "/r")
    for df in (gate.gate_signatures(results), gate.error_summary(results)):
        plan = _plan(df)
        assert "(validation_id" in plan.split("PartitionFilters: [")[1].split("]")[0] and "= v2)" in plan
        assert plan.count("FileScan") == 1


def test_ingest_parses_every_workbook_once(spark, tmp_dir):
    import os

    from strata import jobs
    from deposits import build_workbook, meta_rows
    os.makedirs(tmp_dir + "/d/submissions/s")
    meta = {"g3mt_version": "1", "schema_file": "s", "target_node": "n"}
    with open(tmp_dir + "/d/submissions/s/a.xlsx", "wb") as fh:
        fh.write(build_workbook({"_g3mt": meta_rows(meta, {"n": "S"}), "S": [["a"], ["h"], ["1"]]}))
    parsed = spark.sparkContext.accumulator(0)
    from strata.sources import workbook
    whole = workbook.stored_cells
    workbook.stored_cells = lambda files: whole(files).mapInPandas(_counting(parsed), workbook.STORED_SCHEMA)
    try:
        jobs.ingest(spark, "file://" + tmp_dir + "/d", "file://" + tmp_dir + "/b", batch_marker="m")
    finally:
        workbook.stored_cells = whole
    assert parsed.value == 2 + 5 + 3  # two sheets, rows of the metadata, rows of the other


def test_workbook_landing_keeps_contents_out_of_shuffles(spark):
    plan = _plan(entry.queries()["workbook_landing"](spark, SF))
    assert "content" not in plan and "MapInArrow" not in plan  # rows of sheets, written once, are all it reads


def _counting(counter):
    def run(batches):
        for b in batches:
            counter.add(len(b))
            yield b
    return run


def test_scans_read_only_needed_columns(spark):
    plan = _plan(entry.queries()["link_check"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan
    assert "PushedFilters: [IsNotNull(user_id)]" in plan


def test_literal_vocabulary_is_broadcast(spark):
    plan = _plan(entry.queries()["vocab_map"](spark, SF))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_no_cartesian_products_anywhere(spark):
    for name, fn in entry.queries().items():
        if name.startswith("op") or name == "pipeline":
            continue  # those are run and checked in tests/llm
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
