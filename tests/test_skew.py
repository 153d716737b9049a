"""Hot keys: one key holding a third of the rows still gives whole, exact
results (no rows dropped or capped)."""

from pyspark.sql import functions as F

from strata.operators import gate, landing, promote


def test_dedupe_with_a_hot_hash(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.lit("v").alias("v"))
    bronze = landing.bronze_from_table(df, file="f", sheet="s", row=F.col("k"), study_id="st", batch_id="b1",
                                       ingested_at="2024-01-01T00:00:00+00:00")
    newer = landing.bronze_from_table(df.filter("k = -1").limit(1), file="f", sheet="s", row=F.col("k"),
                                      study_id="st", batch_id="b2", ingested_at="2024-02-01T00:00:00+00:00")
    out = promote.dedupe_bronze(bronze.unionByName(newer).repartition(7))
    assert out.count() == 2 * n // 3 + 1
    assert out.filter("k = '-1'").first()._src_batch_id == "b2"
    assert landing.dedupe_in_run(bronze.repartition(5)).count() == 2 * n // 3 + 1


def test_link_check_with_a_hot_foreign_key(spark):
    child = spark.range(3000).select(F.col("id").alias("cid"),
                                     F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 10_000)
                                     .alias("fk"))
    parent = spark.range(100).select(F.col("id").alias("pk"))
    missing = promote.link_check(child, parent, "fk", "pk")
    assert missing.count() == 2000
    counts = promote.link_counts(child, parent, "fk", "pk").first()
    assert (counts.n_children, counts.n_missing) == (3000, 2000)


def test_gate_with_a_hot_study(spark):
    from strata.operators import checks
    rows = [("v1", None, "subject", "hot" if i % 3 == 0 else f"s{i}", "FAIL", "k", None, "enum", None,
             "bad", "1", str(i)) for i in range(900)]
    res = spark.createDataFrame(rows, checks.RESULT_SCHEMA).repartition(6)
    sig = {r.study_id: r.n for r in gate.gate_signatures(res).collect()}
    assert sig["hot"] == 300 and len(sig) == 601
