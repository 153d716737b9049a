"""Releases: ledger, pins, import order and upload/delete plans
(T1, T2, T5, T6, T7, F7, F10, F12, F13, J7, J8, J9, J10, J11, K8).

A snapshot is an immutable table state. Without an Iceberg catalog a table
keeps its commits as a ``snapshot_id`` partition column; reading at a pin is a
partition filter (pruned at the scan), and a cluster with Iceberg can swap in
``VERSION AS OF`` behind the same functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.naming import parse_model_name
from strata.functions.versions import release_order

LEDGER_COLUMNS = ("release_tag", "db_name", "model_name", "snapshot_id", "github_sha")
LEDGER_KEY = ("release_tag", "db_name", "model_name")


def latest_release(ledger: DataFrame, override: str | None = None, tag: str = "release_tag") -> DataFrame:
    """The greatest release tag (one row). An explicit tag wins."""
    if override:
        return ledger.sparkSession.createDataFrame([(override,)], f"{tag} string")
    return ledger.select(tag).distinct().orderBy(*release_order(tag)).limit(1)


def previous_release(ledger: DataFrame, tag: str = "release_tag") -> DataFrame:
    """The release before the latest (rollback target): second distinct
    tag in release order. Top-2 first, so only two rows reach the window."""
    top2 = ledger.select(tag).distinct().orderBy(*release_order(tag)).limit(2)
    w = Window.orderBy(*release_order(tag))
    return top2.withColumn("__rn", F.row_number().over(w)).filter("__rn = 2").drop("__rn")


def release_rows(ledger: DataFrame, release: DataFrame | str) -> DataFrame:
    """the chosen tag's rows whose database is a gold one."""
    if isinstance(release, str):
        rows = ledger.filter(F.col("release_tag") == release)
    else:
        rows = ledger.join(release.select("release_tag"), "release_tag", "left_semi")
    return rows.filter(F.col("db_name").contains("gold"))


def export_models(rows: DataFrame) -> DataFrame:
    """P8 over ledger rows: study, write table and ``v``-prefixed tag."""
    parsed = rows.withColumn("__p", parse_model_name("model_name"))
    return parsed.select(
        "release_tag", "db_name", "model_name", "snapshot_id",
        F.col("__p.study_id").alias("study_id"), F.col("__p.write_table").alias("write_table"),
        F.col("__p.finding").alias("finding"),
        F.concat(F.lit("v"), F.col("release_tag")).alias("release_dir"))


def not_ci(db_name: Column | str = "db_name") -> Column:
    """never pin a CI snapshot."""
    c = F.col(db_name) if isinstance(db_name, str) else db_name
    return ~c.startswith("ci_")


def append_ledger_rows(existing: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The rows to append — CI databases dropped, and rows already
    present for (tag, db, model) skipped, so re-pushing a tag is idempotent."""
    return (new_rows.filter(not_ci("db_name"))
            .join(existing.select(*LEDGER_KEY), list(LEDGER_KEY), "left_anti")
            .dropDuplicates(list(LEDGER_KEY)))


def resolve_model_db(listing: DataFrame, models: DataFrame) -> DataFrame:
    """The database holding each model, from a catalog listing
    (``db_name, table_name``); CI databases are never chosen (F10)."""
    real = listing.filter(not_ci("db_name")).select("db_name", F.col("table_name").alias("model_name"))
    return models.join(real, "model_name", "left")


def latest_snapshots(snapshots: DataFrame, table: str = "table_name", snapshot_col: str = "snapshot_id") -> DataFrame:
    """The highest snapshot per table."""
    return snapshots.groupBy(table).agg(F.max(snapshot_col).alias(snapshot_col))


def read_at(table: DataFrame, pin: int | Column, snapshot_col: str = "snapshot_id",
            cumulative: bool = False) -> DataFrame:
    """The table at a pinned snapshot; never the latest. With
    ``cumulative`` the table is append-only and a snapshot holds every commit
    up to it (``<=``); otherwise each snapshot partition is a full copy."""
    p = pin if isinstance(pin, Column) else F.lit(pin)
    cond = F.col(snapshot_col) <= p if cumulative else F.col(snapshot_col) == p
    return table.filter(cond)


def read_latest(table: DataFrame, snapshot_col: str = "snapshot_id") -> DataFrame:
    """Latest snapshot, then the table at it."""
    from strata.operators.gate import keep_greatest
    return keep_greatest(table, snapshot_col)


def read_pinned(table: DataFrame, pins: DataFrame, keys: tuple[str, ...] = (),
                snapshot_col: str = "snapshot_id", cumulative: bool = False) -> DataFrame:
    """Ledger pins drive the read. ``pins`` has ``snapshot_id`` plus the
    ``keys`` that pick the table (e.g. study). Equality pins are a join on the
    partition column, so dynamic partition pruning applies; cumulative pins
    are a range condition against a pin set that is one row per model."""
    if not cumulative:
        return table.join(pins, list(keys) + [snapshot_col], "inner")
    p = pins.withColumnRenamed(snapshot_col, "__pin")
    cond = [table[k] == p[k] for k in keys] + [table[snapshot_col] <= p["__pin"]]
    return table.join(p, cond, "inner").drop(*[p[k] for k in keys])


def import_order(spark: SparkSession, links: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """T5: parents before children. ``level`` is the longest path from a root
    (a node with no parent link); ``pos`` orders by (level, node). Nodes on or
    behind a cycle get ``level`` null and ``cycle`` true instead of looping.

    Links are dictionary-sized. Nodes settle level by level: one whose parents
    are all settled is a level below the deepest of them, so every link is
    looked at once, however many paths there are; what a cycle holds back
    never settles."""
    parents: dict[str, set[str]] = {}
    children: dict[str, list[str]] = {}
    for child, parent in links.select("child", "parent").distinct().collect():
        parents.setdefault(child, set()).add(parent)
        parents.setdefault(parent, set())
        children.setdefault(parent, []).append(child)
    for r in nodes.select("node").collect() if nodes is not None else ():
        parents.setdefault(r.node, set())
    waiting = {n: len(p) for n, p in parents.items()}
    level: dict[str, int] = {}
    settled, depth = [n for n, w in waiting.items() if w == 0], 0
    while settled:
        level.update((n, depth) for n in settled)
        below = []
        for n in settled:
            for c in children.get(n, ()):
                waiting[c] -= 1
                if waiting[c] == 0:
                    below.append(c)
        settled, depth = below, depth + 1
    order = sorted(parents, key=lambda n: (n not in level, level.get(n, 0), n))
    rows = [(n, level.get(n), i, n not in level) for i, n in enumerate(order)]
    return spark.createDataFrame(rows, "node string, level bigint, pos bigint, cycle boolean")


def upload_plan(records: DataFrame, order: DataFrame, node: str = "node",
                key: str = "submitter_id") -> DataFrame:
    """Records in import order, parents first. Records of a node that the
    order does not know come last, with null level and pos. Rows that agree in
    every sort key are range-partitioned together. The order is
    dictionary-sized and broadcast: by node, most records would meet in one
    task."""
    o = order.select(F.col("node").alias("__n"), "level", "pos")
    j = records.join(F.broadcast(o), F.col(node) == F.col("__n"), "left").drop("__n")
    return j.orderBy(F.col("pos").asc_nulls_last(), key)


def select_audit(audit: DataFrame, project_id: str, version: str, api_endpoint: str) -> DataFrame:
    """upload-audit rows of one project/version/endpoint. A leading ``v``
    on either side of the version is ignored."""
    norm = F.regexp_replace(F.col("version"), r"^[vV]", "")
    want = version[1:] if version[:1] in ("v", "V") else version
    return audit.filter((F.col("project_id") == project_id) & (norm == want)
                        & (F.col("api_endpoint") == api_endpoint))


def delete_plan(audit_rows: DataFrame, order: DataFrame) -> DataFrame:
    """Records to delete, children first (position descending); those
    of a node that the order does not know come first, as nothing can be said
    to hang on them last."""
    o = order.select(F.col("node").alias("__n"), "level", "pos")
    j = audit_rows.join(F.broadcast(o), F.col("node") == F.col("__n"), "left").drop("__n")
    return j.orderBy(F.col("pos").desc_nulls_first(), "gen3_guid")
