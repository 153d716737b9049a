"""The pipeline's jobs, composed from the operators: ingest (deposits ->
bronze), dump (silver at its latest snapshot -> JSON records), validate
(records -> results -> gate) and release (ledger -> JSON at pins). Each is one
or a few Spark plans; the driver only handles run parameters and
metadata-sized lists (tables, models, the dictionary). Units that do not
depend on each other (tables, models) run side by side, every unit is tried,
and what failed is raised by name after the others are written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.extend import custom_check
from strata.functions import ids, naming
from strata.operators import checks, gate, landing, links, release, tables, typed
from strata.session import remove_path, scratch_path
from strata.sinks import writers
from strata.sources import files, records, workbook
from strata.sources.dictionary import Dictionary


class GateFailed(RuntimeError):
    """The latest run has real failures (signatures are attached)."""

    def __init__(self, message: str, signatures: DataFrame):
        super().__init__(message)
        self.signatures = signatures


# ------------------------------------------------------------------- ingest

FINDING_ROWS = "__findings"


@dataclass
class Landed:
    """One run's parsed deposits, staged once: bronze rows by table, and the
    findings."""
    spark: SparkSession
    path: str
    rows: DataFrame
    headers: dict[str, list[str]]
    report: DataFrame
    failed: list[str]

    @property
    def tables(self) -> list[str]:
        return sorted(self.headers)

    @property
    def findings(self) -> DataFrame:
        """File failures and missing sheets (as parsed), and headers that were
        renamed or landed under several names."""
        own = self.rows.filter(F.col("table_name") == FINDING_ROWS) \
            .select("file", "study_id", "node", "sheet", "error", "severity")
        names = landing.header_name_report(self.rows.filter(F.col("table_name") != FINDING_ROWS)).select(
            F.lit(None).cast("string").alias("file"), F.lit(None).cast("string").alias("study_id"),
            F.col("table_name").alias("node"), F.lit(None).cast("string").alias("sheet"),
            F.concat(F.lit("header '"), F.col("header"), F.lit("' stands under "), F.array_join("safe_names", ", ")).alias("error"),
            F.lit("info").alias("severity"))
        return own.unionByName(names)

    def table(self, name: str) -> DataFrame:
        """One bronze table's rows, widened to its columns (one partition)."""
        return landing.widen(self.rows.filter(F.col("table_name") == name), self.headers[name])

    def remove(self) -> None:
        """Delete the staging folder of this run."""
        remove_path(self.spark, self.path)


def _landing_rows(landed: DataFrame, batch_id: str, ingested_at: str) -> DataFrame:
    """Parsed rows in bronze map form; findings are rows of a table of their
    own. One row per table and row hash (W3)."""
    cells = landing.bronze_from_cells(landed, batch_id=batch_id, ingested_at=ingested_at,
                                      keep=("file", "study_id", "sheet", "headers", "error", "severity"))
    finding = F.col("error").isNotNull()
    return cells.withColumn("table_name", F.when(finding, F.lit(FINDING_ROWS)).otherwise(F.col("table_name"))) \
        .withColumn("__once", F.when(finding, F.concat_ws("|", "file", "sheet", "node", "error"))) \
        .dropDuplicates(["table_name", "row_hash", "__once"]).drop("__once")


def _summary(rows: DataFrame) -> tuple[dict[str, list[str]], list[tuple], list[str]]:
    """(columns per table, report rows, failed files) in one aggregation; what
    reaches the driver is one row per table and per failed file."""
    failed = F.when((F.col("table_name") == FINDING_ROWS) & (F.col("severity") == "error"), F.col("file"))
    got = rows.groupBy("table_name", failed.alias("failed")).agg(
        F.count(F.lit(1)).alias("n"), F.collect_set(F.map_keys("safe_cells")).alias("layouts")).collect()
    headers = {r.table_name: sorted({c for x in r.layouts for c in x}) for r in got if r.table_name != FINDING_ROWS}
    report = [(r.table_name, r.n, headers[r.table_name]) for r in got if r.table_name != FINDING_ROWS]
    return headers, sorted(report), sorted(r.failed for r in got if r.failed is not None)


_REPORT = "table_name string, n_rows bigint, columns array<string>"


def stage_landing(spark: SparkSession, landed: DataFrame, *, batch_id: str, ingested_at: str) -> Landed:
    """Parse once: data and findings are written together to the shared
    scratch folder, partitioned by target table (rebalanced, so files follow
    sizes and not tasks x tables). Everything after reads the staged rows."""
    path = scratch_path(spark, f"landing/{writers.new_run_key()}")
    _landing_rows(landed, batch_id, ingested_at).hint("rebalance", "table_name") \
        .write.partitionBy("table_name").parquet(path)
    rows = spark.read.parquet(path)
    headers, report, failed = _summary(rows)
    return Landed(spark, path, rows, headers, spark.createDataFrame(report, _REPORT), failed)


def write_bronze_tables(staged: Landed, bronze_root: str, fmt: str = "parquet", run_key: str | None = None) -> None:
    """K1: one append per bronze table, several at a time."""
    key = run_key or writers.new_run_key()
    bad = writers.run_units(staged.tables, lambda t: writers.append_bronze(
        staged.table(t), f"{bronze_root.rstrip('/')}/{t}", fmt, run_key=key))
    if bad:
        raise writers.PartialFailure(f"{len(bad)} bronze table(s) not written: "
                                     + writers.name_some([f"{t} ({e})" for t, e in bad]))


def ingest(spark: SparkSession, deposit_root: str, bronze_root: str, *, prefix: str = "submissions",
           study: str | None = None, batch_marker: str | None = None, dry_run: bool = False,
           fmt: str = "parquet", findings_path: str | None = None) -> DataFrame:
    """Deposits -> one bronze table per (study, node), appended under a new
    batch. Returns the per-table report (rows, columns). Failures, missing
    sheets and renamed headers are appended to ``findings_path`` (by default
    ``<bronze_root>-findings``); good workbooks are written before the job
    raises naming failed ones. A dry run parses and reports, and writes
    nothing."""
    batch, at = ids.batch_id(batch_marker), ids.ingested_at()
    with workbook.landing(workbook.workbook_contents(spark, deposit_root, prefix, study)) as landed:
        if dry_run:
            _, report, failed = _summary(_landing_rows(landed, batch, at))
            if failed:
                raise writers.PartialFailure(f"{len(failed)} workbook(s) would fail: {writers.name_some(failed)}")
            return spark.createDataFrame(report, _REPORT)
        staged = stage_landing(spark, landed, batch_id=batch, ingested_at=at)
    try:
        writers.append_bronze(staged.findings.withColumn(writers.BRONZE_PARTITION, F.lit(batch)),
                              findings_path or bronze_root.rstrip("/") + "-findings", fmt)
        write_bronze_tables(staged, bronze_root, fmt)
    finally:
        staged.remove()
    if staged.failed:
        raise writers.PartialFailure(
            ("no workbook could be read: " if not staged.tables else "") +
            f"{len(staged.failed)} workbook(s) failed: {writers.name_some(staged.failed)}")
    return staged.report


# --------------------------------------------------------------------- dump

def dump(spark: SparkSession, names: DataFrame, read_table: Callable[[str], DataFrame], out_root: str, *,
         target: str = "real", exclude: str = "", validation_id: str | None = None) -> str:
    """Silver tables -> JSON records for a validation run, under the target's
    key prefix: ``<out_root>/<prefix>/study_id=/validation_id=/table_name=/
    snapshot_id=``. ``names`` lists the layer's tables (``table_name``);
    helper tables and those in ``exclude`` (a comma list) are left out; each
    table is read at its latest snapshot (column ``snapshot_id``). Tables
    whose name holds no study, and tables that could not be read, are raised
    by name after the others are written. Returns the validation id."""
    settings = tables.target(target)
    vid = validation_id or ids.validation_id()
    todo = tables.export_candidates(names, tables.parse_exclude_list(spark, exclude)).select(
        "table_name", naming.study_from_table("table_name").alias("study_id")).distinct().collect()
    root = f"{out_root.rstrip('/')}/{settings['key_prefix']}"

    def one(row) -> None:
        if not row.study_id:
            raise ValueError(f"no study in the name of table '{row.table_name}'")
        records = release.read_latest(read_table(row.table_name)).withColumns({
            "study_id": F.lit(row.study_id), "validation_id": F.lit(vid), "table_name": F.lit(row.table_name),
            "snapshot_id": F.col("snapshot_id").cast("string")})
        writers.dump_json(records, root)
    bad = writers.run_units(todo, one)
    if bad:
        raise writers.PartialFailure(f"{len(bad)} table(s) not dumped: "
                                     + writers.name_some([f"{r.table_name} ({e})" for r, e in bad]))
    return vid


class Dump(NamedTuple):
    """A dump run as read back: its records per node, its studies, and an ERROR
    row for each line that is no record."""
    records: dict[str, DataFrame]
    studies: DataFrame
    bad: DataFrame


def read_dump(spark: SparkSession, out_root: str, validation_id: str, *, target: str = "real", schema_version: str = "") -> Dump:
    """A dump run's records as frames for ``validate``. The node is what follows
    the study in a table's name (``silver_<study>_<node>``). All tables are read
    in one scan without schema inference, values as text (``records.text_columns``);
    ``validate_dump`` holds rules against JSON's own types instead."""
    root = f"{out_root.rstrip('/')}/{tables.target(target)['key_prefix']}"
    listed = files.list_validation_artifacts(spark, root).filter(F.col("validation_id") == validation_id)
    parsed = records.read_records(spark, root, validation_id)
    return Dump(records.text_columns(parsed), gate.run_studies(listed, validation_id),
                records.bad_lines(parsed, schema_version=schema_version, validation_id=validation_id))


# ----------------------------------------------------------------- validate

#: A custom check: its name, when a record fails, and the message.
CustomCheck = tuple[str, Column, Column]


def _node_findings(records: Mapping[str, DataFrame], node: str, rules: list, named: set, links: list, *, vid: str,
                   version: str, custom: Sequence[CustomCheck], root_node: str | None) -> DataFrame:
    """All findings of one node's records: rules, keys the dictionary does not
    know, links, the root's requirement and custom checks."""
    df = records[node]
    keep = {"validation_id": vid, "schema_version": version}
    parts = [checks.findings_for_node(df, node, rules, **keep)]
    own = [x for x in links if x.child == node]
    known = {p for n, p in named if n == node} | {c for x in own for c in checks.link_columns(x.name)}
    parts.append(checks.additional_columns(df, node, known, **keep))
    parts += checks.dictionary_links(records, node, own, **keep)
    if node == root_node:
        parts.append(checks.root_requirement(df, node, **keep))
    parts += [custom_check(df, node=node, name=name, fails=fails, message=message, **keep) for name, fails, message in custom]
    return checks.assemble_results(parts)


def validate(spark: SparkSession, records: Mapping[str, DataFrame], dictionary: Dictionary, *, results_path: str,
             studies: DataFrame, validation_id: str | None = None, policy: gate.GatePolicy = gate.GatePolicy(),
             schema_version: str | None = None, csv_path: str | None = None,
             typed_records: DataFrame | None = None, root_node: str | None = None,
             policy_path: str | None = None, custom: Mapping[str, Sequence[CustomCheck]] | None = None
             ) -> DataFrame | None:
    """Records per node -> findings, ERROR rows, PASS markers -> one results
    append -> gate. ``typed_records`` (node, submitter_id, study_id) feeds the
    unknown-node check; a node of ``records`` that the dictionary lacks gives
    an ERROR row per study. ``custom`` holds further checks per node.

    Nodes are checked side by side and staged. Where a node's data cannot be
    read, its studies are checked one by one, a study that fails gets one
    ERROR row and no PASS marker, and all others are judged; everything is
    written in one append before the job raises, naming the failed studies.
    Raises :class:`GateFailed` after writing. With no studies nothing is
    written and the gate is skipped (F11)."""
    if studies.isEmpty():
        return None
    vid = validation_id or ids.validation_id()
    version = schema_version or (dictionary.version.first()["schema_version"] or "")
    all_studies = [r.study_id for r in studies.select("study_id").distinct().collect()]  # run-sized
    broken = [r["error"] for r in dictionary.ref_errors.collect()]  # dictionary-sized
    if broken:
        # The schema does not resolve, so nothing can be checked. Each
        # study gets an ERROR row; the rows are written before the job raises.
        err = ValueError("; ".join(sorted(broken)))
        writers.append_results(checks.error_rows(spark, [(s, err) for s in all_studies], validation_id=vid,
                                                 schema_version=version), results_path)
        raise err
    rules, links = checks.collect_rules(dictionary.rules), dictionary.links.collect()
    named = {(r.node, r.property) for r in dictionary.properties.collect()}
    known = {r.node for r in dictionary.nodes.collect()}
    staging = scratch_path(spark, f"validate/{writers.new_run_key()}")
    failed: dict[str, Exception] = {}

    def found(node: str, study: str | None = None) -> DataFrame:
        use = records if study is None else {**records, node: records[node].filter(F.col("study_id") == study)}
        if node not in known:
            typed = use[node].select(F.lit(node).alias("node"), F.col("submitter_id").cast("string"), "study_id")
            return checks.unknown_nodes(typed, dictionary.nodes, validation_id=vid, schema_version=version)
        return _node_findings(use, node, rules, named, links, vid=vid, version=version,
                              custom=(custom or {}).get(node, ()), root_node=root_node)

    bad = writers.run_units(list(records), lambda n: found(n).write.parquet(f"{staging}/all/node={n}"))
    for node, _ in bad:  # the rest of that node's studies still count
        for study, error in writers.run_units(all_studies, lambda s, n=node: found(n, s).write.parquet(f"{staging}/each/node={n}/study={s}")):
            failed.setdefault(study, error)
    parts = [checks.empty_results(spark)]
    good = [n for n in records if n not in {n for n, _ in bad}]
    parts += [spark.read.schema(checks.RESULT_SCHEMA).parquet(f"{staging}/all/node={n}") for n in good]
    parts += [spark.read.schema(checks.RESULT_SCHEMA).parquet(f"{staging}/each/node={n}/study={s}")
              for n, _ in bad for s in all_studies if s not in failed]
    if typed_records is not None:
        parts.append(checks.unknown_nodes(typed_records, dictionary.nodes, validation_id=vid, schema_version=version))
    if failed:
        parts.append(checks.error_rows(spark, sorted(failed.items()), validation_id=vid, schema_version=version))
    everything = checks.assemble_results(parts)
    marks = checks.pass_markers(studies, everything, validation_id=vid, schema_version=version)
    writers.append_results(checks.assemble_results([everything, marks]), results_path)
    if policy_path:  # E1: the effective gate policy, recorded with the run
        policy.as_frame(spark, vid).write.mode("append").parquet(policy_path)
    written = writers.read_results(spark, results_path)
    if csv_path:
        writers.results_csv(written.filter(F.col("validation_id") == vid), csv_path)
    if failed:
        raise writers.PartialFailure(f"{len(failed)} stud(ies) could not be checked: "
                                     + writers.name_some([f"{s} ({e})" for s, e in failed.items()]))
    signatures = gate.gate_signatures(written, policy)
    if not signatures.isEmpty():
        studies_msg = gate.gate_message(signatures).first()
        raise GateFailed(f"{studies_msg['n_signatures']} failure signature(s) stand against the gate, in studies "
                         f"{studies_msg['studies']}", signatures)
    return signatures


def validate_dump(spark: SparkSession, out_root: str, validation_id: str, dictionary: Dictionary, *, results_path: str,
                  target: str = "real", policy: gate.GatePolicy = gate.GatePolicy(), root_node: str | None = None,
                  root_link: str = "programs") -> DataFrame | None:
    """A dump run's lines -> results with the position of each record -> gate.

    The lines of all studies and tables are read in one scan and parsed once
    (``records.read_records``). Lines that are no record and records of nodes
    that the dictionary lacks are ERROR rows; rules are held against JSON's own
    types in one pass, all links in another; studies without a finding get a
    PASS row. Everything is one append, written before :class:`GateFailed` or a
    broken dictionary is raised. With no studies nothing is written."""
    root = f"{out_root.rstrip('/')}/{tables.target(target)['key_prefix']}"
    version = dictionary.version.first()["schema_version"] or ""
    keep = {"validation_id": validation_id, "schema_version": version}
    parsed = records.read_records(spark, root, validation_id)
    studies = parsed.select("study_id").distinct()
    if studies.isEmpty():
        return None
    broken = sorted({r["error"] for r in dictionary.ref_errors.collect()}
                    | {f"format '{f}' is not checked ({at})" for _, at, f in typed.unchecked_formats(dictionary.schemas)})
    if broken:
        err = ValueError("; ".join(broken))
        writers.append_results(checks.error_rows(spark, [(r.study_id, err) for r in studies.collect()], **keep), results_path)
        raise err
    lost = checks.unknown_nodes(parsed.filter("bad IS NULL"), dictionary.nodes, **keep)
    known = parsed.join(F.broadcast(dictionary.nodes), "node", "left_semi")  # dictionary-sized
    all_links = dictionary.links.collect()
    schemas = {n: {**s, "properties": {**{x.name: {} for x in all_links if x.child == n}, **(s.get("properties") or {})}}
               for n, s in dictionary.schemas.items()}
    if root_node in schemas:  # V6
        s = schemas[root_node]
        schemas[root_node] = {**s, "required": [*(s.get("required") or []), root_link],
                              "properties": {root_link: {}, **s["properties"]}}
    found = checks.assemble_results([
        checks.empty_results(spark), records.bad_lines(parsed, **keep), lost, typed.typed_findings(known, schemas, **keep),
        links.link_findings(known, all_links, **keep)])
    staging = scratch_path(spark, f"validate/{writers.new_run_key()}")
    found.write.parquet(staging)
    found = spark.read.schema(checks.RESULT_SCHEMA).parquet(staging)
    marks = checks.pass_markers(studies, found, **keep)
    writers.append_results(checks.assemble_results([found, marks]), results_path)
    signatures = gate.gate_signatures(writers.read_latest_results(spark, results_path), policy)
    if not signatures.isEmpty():
        said = gate.gate_message(signatures).first()
        raise GateFailed(f"{said['n_signatures']} failure signature(s) stand against the gate, in studies {said['studies']}", signatures)
    return signatures


# ------------------------------------------------------------------ release

def export_release(spark: SparkSession, ledger: DataFrame, read_model: Callable[[str, str], DataFrame],
                   out_root: str, order: DataFrame, *, tag: str | None = None) -> DataFrame:
    """Latest (or given) release -> every gold model at its pinned snapshot
    -> JSON lines per ``v<tag>/<study>/<table>`` plus the import order per
    release and study. ``read_model(db, model)`` returns the model's table
    with a ``snapshot_id`` column. Returns the model list.

    An empty ledger raises. Models are written side by side and counted while
    they are written. Models whose name breaks the convention are recorded
    under ``release_findings``; they, models that failed, and models without
    rows at their pin are raised by name after all others are written. A
    release without gold models exports nothing (F12)."""
    chosen = release.latest_release(ledger, tag)
    if ledger.isEmpty() or chosen.isEmpty():
        raise LookupError("the release ledger holds no release")
    parsed = release.export_models(release.release_rows(ledger, chosen))
    rows = parsed.collect()  # models are metadata-sized
    misnamed = [r for r in rows if r["finding"] is not None]
    good = [r for r in rows if r["finding"] is None]
    root = out_root.rstrip("/")
    if misnamed:
        writers.dump_json(spark.createDataFrame(
            [(r["release_dir"], r["db_name"], r["model_name"], r["finding"]) for r in misnamed],
            "release_dir string, db_name string, model_name string, finding string"), f"{root}/release_findings", ("release_dir",))
    empty: list[str] = []

    def one(r) -> None:
        t = release.read_at(read_model(r["db_name"], r["model_name"]), r["snapshot_id"])
        cols = [c for c in t.columns if c != "snapshot_id"]
        records = t.select(F.to_json(F.struct(*cols), writers.KEEP_NULLS).alias("record"))
        if not writers.export_release(records, f"{root}/release_jsons", r["release_dir"], r["study_id"], r["write_table"], r["db_name"]):
            empty.append(f"{r['db_name']}.{r['model_name']}@{r['snapshot_id']}")

    bad = writers.run_units(good, one)
    if good:
        writers.write_import_order(order, parsed.filter(F.col("finding").isNull()), f"{root}/release_import_order")
    problems = [f"{r['model_name']}: {r['finding']}" for r in misnamed] + [f"{r['model_name']}: {e}" for r, e in bad] \
        + [f"{m}: no rows at its pin" for m in empty]
    if problems:
        raise writers.PartialFailure(f"{len(problems)} model(s) not exported: {writers.name_some(problems)}")
    return parsed.filter(F.col("finding").isNull())
