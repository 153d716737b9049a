"""Commits, keyed appends, pins and greatest partitions of stored tables."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import checks, release
from strata.plans import commits as plans
from strata.sinks import buckets, manifest, schema_ledger, writers
from strata.sources import snapshots

SF = "/root/testdata/sf0.001"


def _row(spark, study, vid, text="x"):
    return checks.error_row(spark, study, OSError(text), validation_id=vid, schema_version="1")


def test_appends_under_one_id_add_up_and_replays_do_not(spark, tmp_dir):
    path = tmp_dir + "/r"
    for study in ("a", "b", "a"):  # the third is the first again
        writers.append_results(_row(spark, study, "v1"), path)
    writers.append_results(_row(spark, "c", "v1"), path, run_key="k")
    writers.append_results(_row(spark, "d", "v1"), path, run_key="k")  # a retry with other rows
    assert sorted(r.study_id for r in writers.read_results(spark, path).collect()) == ["a", "b", "d"]
    told = manifest.audit(spark, path, writers.RESULTS_UNIT).collect()
    assert [r.status for r in told] == ["complete"] * 3
    writers.append_results(_row(spark, "a", "v1").filter("false"), path)
    assert writers.read_results(spark, path).count() == 3


def test_a_half_written_unit_is_not_committed(spark, tmp_dir, monkeypatch):
    df = spark.range(10).withColumn("p", F.lit("x"))
    real = manifest._replace
    monkeypatch.setattr(manifest, "_replace", lambda d, *a: real(d.limit(7) if "id" in d.columns else d, *a))
    with pytest.raises(manifest.IncompleteWrite):
        manifest.write_committed(df.withColumn("q", F.lit("y")).unionByName(df.withColumn("q", F.lit("z"))), tmp_dir + "/t", ["p", "q"],
                                 [["x", "y"]], run_key="r")
    assert not os.path.exists(f"{tmp_dir}/t/_commits")


def test_a_digest_tells_other_rows_of_the_same_number(spark, tmp_dir):
    path = tmp_dir + "/t"
    df = spark.createDataFrame([("p/1: é", 1), ("p/1: é", 1), (None, 2)], "p string, v int")
    manifest.write_committed(df, path, ["p"], [["p/1: é"], [None]], run_key="r")
    assert {(r.unit, r.status) for r in manifest.audit(spark, path, ["p"]).collect()} == {('{"p":"p/1: é"}', "complete"), ('{"p":null}', "complete")}
    assert manifest.read_committed(spark, path, ["p"]).count() == 3
    df.withColumn("v", F.lit(3)).where("p IS NULL").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("p").parquet(path)
    assert {r.status for r in manifest.audit(spark, path, ["p"]).where("unit like '%null%'").collect()} == {"differs"}


def test_a_model_without_records_takes_its_old_ones_away(spark, tmp_dir):
    model = spark.createDataFrame([("{}",)], "record string")
    unit = ("v1", "staging/b", "t", "g_gold_db")
    assert writers.export_release(model, tmp_dir + "/e", *unit) == 1
    assert writers.export_release(model, tmp_dir + "/e", "v1", "staging/b", "t", "h_gold_db") == 1
    assert writers.export_release(model.filter("false"), tmp_dir + "/e", *unit) == 0
    assert [r.db_name for r in spark.read.text(tmp_dir + "/e").collect()] == ["h_gold_db"]


def test_pins_prune_partitions_when_the_query_runs(spark):
    got = plans.pinned_partitions(spark, SF)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scan = [x for x in plan.splitlines() if "PartitionFilters" in x and "dynamicpruning" in x]
    assert scan and "table_name" in scan[0]


def test_the_greatest_partition_opens_no_past_file(spark, tmp_dir):
    path = tmp_dir + "/r"
    for vid in ("20240101", "20240201", "20240301"):
        writers.append_results(_row(spark, "s", vid, vid), path)
    for f in glob.glob(f"{path}/validation_id=20240[12]01/*/*.parquet"):
        os.chmod(f, 0o644)
        with open(f, "wb") as fh:
            fh.write(b"no parquet at all")
    got = writers.read_latest_results(spark, path)
    assert [r.validation_id for r in got.collect()] == ["20240301"]
    assert len(got.inputFiles()) == 1
    with pytest.raises(LookupError):
        snapshots.read_greatest(spark, tmp_dir + "/none", "validation_id")


def test_snapshots_are_ordered_as_numbers_and_values_unescaped(spark, tmp_dir):
    spark.createDataFrame([(1, "9", "a=b/c"), (2, "10", "a=b/c"), (3, "10", "é x"), (4, None, "é x")], "k int, snapshot_id string, table_name string") \
        .write.partitionBy("table_name", "snapshot_id").parquet(tmp_dir + "/t")
    listing = snapshots.snapshot_listing(spark, tmp_dir + "/t")
    assert {tuple(r) for r in release.latest_snapshots(listing).collect()} == {("a=b/c", 10), ("é x", 10)}
    one = snapshots.read_partition(spark, tmp_dir + "/t", "table_name", "a=b/c")
    assert sorted(r.k for r in one.collect()) == [1, 2]
    assert snapshots.greatest_partition(spark, f"{tmp_dir}/t/{snapshots.partition_folder('table_name', 'a=b/c')}", "snapshot_id", int) == "10"


def test_the_schema_ledger_replaces_reading_footers(spark, tmp_dir):
    path = tmp_dir + "/b"
    one = spark.createDataFrame([("1", "a")], "x string, _src_batch_id string")
    writers.append_bronze(one, path, run_key="r1")
    writers.append_bronze(one.select(F.lit("2").alias("y"), F.lit("b").alias("_src_batch_id")), path, run_key="r2")
    for f in glob.glob(f"{path}/_src_batch_id=a/*/*.parquet"):
        with open(f, "wb") as fh:
            fh.write(b"no parquet at all")
    got = writers.read_bronze(spark, path)
    assert set(got.columns) == {"x", "y", "_src_batch_id"}
    assert [tuple(r) for r in got.where("_src_batch_id = 'b'").select("x", "y").collect()] == [(None, "2")]
    assert {r.batch_id: r.columns for r in schema_ledger.columns_per_batch(spark, path).collect()} == {"a": ["x"], "b": ["y"]}
    with pytest.raises(schema_ledger.ColumnTypeChanged, match="x: string -> int"):
        writers.append_bronze(one.withColumn("x", F.lit(1)), path)


def test_silver_buckets_rewrite_what_a_batch_touches(spark, tmp_dir):
    path = tmp_dir + "/s"

    def batch(keys, at, **more):
        df = spark.createDataFrame([(str(k), f"h{k}", at, "b") for k in keys], "k string, row_hash string, _src_ingested_at string, _src_batch_id string")
        return df.withColumns({c: F.lit(v) for c, v in more.items()})
    assert buckets.merge_batch(batch(range(200), "1"), path, "r1", buckets=8) == 8
    before = {r._bucket: r._version for r in buckets.current(spark, path).collect()}
    assert buckets.merge_batch(batch([5], "2", extra="new"), path, "r2", buckets=99) == 1  # the table keeps its 8
    after = {r._bucket: r._version for r in buckets.current(spark, path).collect()}
    assert sum(before[b] != after[b] for b in before) == 1
    got = buckets.read_merged(spark, path)
    assert got.count() == 200 and [(r._src_ingested_at, r.extra) for r in got.where("k = '5'").collect()] == [("2", "new")]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    buckets.merge_batch(batch([5], "2", extra="new"), path, "r2")  # replayed
    buckets.merge_batch(batch([5, 6], "0"), path, "r3")  # older rows lose
    rows = {(r.k, r._src_ingested_at, r.extra) for r in buckets.read_merged(spark, path).collect()}
    assert rows == {(str(k), "2" if k == 5 else "1", "new" if k == 5 else None) for k in range(200)}
    assert buckets.vacuum(spark, path) > 0 and buckets.vacuum(spark, path) == 0
    assert buckets.read_merged(spark, path).count() == 200
    assert buckets.merge_batch(batch([], "9"), path, "r9") == 0
