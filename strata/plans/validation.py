"""Catalogue: dictionary checks, results and the gate
(V1-V5, V8-V10, P12, P13, U2, A1, A2, A3, A4, F8, E1, S14, T3).

Spark side: the dictionary is parsed with Spark, its rules collected
(metadata) and compiled into one select per node. Oracle side: SQL generated
per (node, rule) as plain WHERE clauses.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import checks, gate, landing, promote
from strata.sinks.writers import KEEP_NULLS
from strata.plans.common import (BATCH_A, BATCH_B, INGESTED_A, INGESTED_B, PROVENANCE, SCHEMA_VERSION,
                                 TESTDATA_DICTIONARY, VALIDATION_NEW, VALIDATION_OLD, conversation_records,
                                 customer_records, document_records, event_records, nation_studies, order_records,
                                 query, table)
from strata.sources.dictionary import Dictionary, dictionary_from_obj

CHECKED_NODES = ("customer", "orders", "documents", "conversations")


def testdata_dictionary(spark: SparkSession) -> Dictionary:
    """The testdata dictionary, parsed."""
    return dictionary_from_obj(spark, TESTDATA_DICTIONARY, "testdata-dictionary.json")


def testdata_rules(spark: SparkSession) -> list[checks.Rule]:
    """The testdata dictionary's rules (metadata)."""
    return checks.collect_rules(testdata_dictionary(spark).rules)


def node_records(spark: SparkSession, sf_dir: str, node: str) -> DataFrame:
    return {"customer": customer_records, "orders": order_records, "documents": document_records,
            "conversations": conversation_records}[node](spark, sf_dir)


def findings(spark: SparkSession, sf_dir: str, nodes=CHECKED_NODES, validators=None,
             validation_id: str = VALIDATION_NEW) -> DataFrame:
    rules = [r for r in testdata_rules(spark) if validators is None or r.validator in validators]
    parts = [checks.findings_for_node(node_records(spark, sf_dir, n), n, rules, validation_id=validation_id,
                                      schema_version=SCHEMA_VERSION) for n in nodes]
    return checks.assemble_results(parts)


# ---------------------------------------------------------------- oracle SQL

_RECORDS_SQL = {
    "customer": """SELECT 'customer_' || CAST(c_custkey AS VARCHAR) AS submitter_id,
        lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g')) AS study_id, c_custkey, c_name, c_nationkey,
        c_acctbal, c_mktsegment
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "orders": """SELECT 'orders_' || CAST(o_orderkey AS VARCHAR) AS submitter_id, s.study_id, o_orderstatus,
        o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
      FROM orders LEFT JOIN (
        SELECT c_custkey, lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g')) AS study_id
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey) s
      ON o_custkey = s.c_custkey""",
    "documents": """SELECT 'documents_' || CAST(d.doc_id AS VARCHAR) AS submitter_id, source AS study_id, text,
        lang, source, n_chars, quality
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "conversations": """SELECT 'conversations_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR)
        AS submitter_id, 'synthetic_dialogs' AS study_id, role, text FROM conversations""",
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _resolved_rules() -> list[tuple[str, str, str, str | None, str]]:
    """(node, property, validator, value, schema_path) from the dictionary
    literal, resolving $ref the same documented way (local keyword wins)."""
    defs = TESTDATA_DICTIONARY["_definitions"]
    out = []
    for node, spec in TESTDATA_DICTIONARY.items():
        if node.startswith("_"):
            continue
        for prop in spec.get("required", []):
            out.append((node, prop, "required", None, f"{node}/required"))
        for prop, sch in spec.get("properties", {}).items():
            merged = dict(defs.get(sch.get("$ref", "").split("/")[-1], {})) if "$ref" in sch else {}
            merged.update({k: v for k, v in sch.items() if k != "$ref"})
            for v in ("type", "enum", "minimum", "maximum", "pattern", "format", "minItems"):
                if v in merged:
                    val = json.dumps(merged[v], separators=(",", ":")) if v == "enum" else str(merged[v])
                    out.append((node, prop, v, val, f"{node}/properties/{prop}/{v}"))
    return out


def _rule_sql(node: str, prop: str, validator: str, value: str | None, path: str, columns: set[str],
              validation_id: str) -> str | None:
    c = prop
    v = f"CAST({c} AS VARCHAR)"
    if validator == "required":
        cond = f"{c} IS NULL" if prop in columns else "TRUE"
        msg = _q(f"'{prop}' is a required property")
        value = prop
    elif prop not in columns:
        return None
    elif validator == "enum":
        vals = json.loads(value)
        listing = "[" + ", ".join("'" + x + "'" for x in vals) + "]"
        cond = f"{c} IS NOT NULL AND {v} NOT IN ({', '.join(_q(x) for x in vals)})"
        msg = f"'''' || {v} || ''' is not one of ' || {_q(listing)}"
    elif validator in ("minimum", "maximum"):
        op, word = ("<", "less than the minimum") if validator == "minimum" else (">", "greater than the maximum")
        cond = f"{c} IS NOT NULL AND CAST({v} AS DECIMAL(38,10)) {op} CAST({_q(value)} AS DECIMAL(38,10))"
        msg = f"{v} || {_q(f' is {word} of {value}')}"
    elif validator == "pattern":
        cond = f"{c} IS NOT NULL AND NOT regexp_matches({v}, {_q(value)})"
        msg = f"'''' || {v} || ''' does not match ' || {_q(repr(value))}"
    elif validator == "type":
        ok = {"number": f"TRY_CAST({v} AS DOUBLE) IS NOT NULL", "integer": f"TRY_CAST({v} AS BIGINT) IS NOT NULL",
              "boolean": f"lower({v}) IN ('true', 'false')"}.get(value, "TRUE")
        cond = f"{c} IS NULL OR NOT ({ok})"
        msg = (f"CASE WHEN {c} IS NULL THEN {_q(f'None is not of type {value!r}')} "
               f"ELSE '''' || {v} || ''' is not of type ' || {_q(repr(value))} END")
    elif validator == "format":
        if value == "date":
            ok = f"TRY_STRPTIME({v}, '%Y-%m-%d') IS NOT NULL AND length({v}) = 10"
        else:
            ok = f"TRY_CAST({v} AS TIMESTAMP) IS NOT NULL"
        cond = f"{c} IS NOT NULL AND NOT ({ok})"
        msg = f"'''' || {v} || ''' is not a ' || {_q(repr(value))}"
    else:
        return None
    return (f"SELECT {_q(validation_id)} AS validation_id, CAST(NULL AS BIGINT) AS \"index\", {_q(node)} AS node, "
            f"study_id, 'FAIL' AS validation_result, {_q(prop)} AS invalid_key, {_q(path)} AS schema_path, "
            f"{_q(validator)} AS validator, {_q(value) if value is not None else 'NULL'} AS validator_value, "
            f"{msg} AS validation_error, {_q(SCHEMA_VERSION)} AS schema_version, submitter_id "
            f"FROM ({_RECORDS_SQL[node]}) r WHERE {cond}")


_NODE_COLUMNS = {
    "customer": {"submitter_id", "study_id", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"},
    "orders": {"submitter_id", "study_id", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"},
    "documents": {"submitter_id", "study_id", "text", "lang", "source", "n_chars", "quality"},
    "conversations": {"submitter_id", "study_id", "role", "text"},
}


def findings_sql(nodes=CHECKED_NODES, validators=None, validation_id: str = VALIDATION_NEW) -> str:
    parts = []
    for node, prop, validator, value, path in _resolved_rules():
        if node not in nodes or (validators is not None and validator not in validators):
            continue
        s = _rule_sql(node, prop, validator, value, path, _NODE_COLUMNS[node], validation_id)
        if s:
            parts.append(s)
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- checks

for _name, _validators in (("check_required", ("required",)), ("check_enum", ("enum",)),
                           ("check_range", ("minimum", "maximum")), ("check_pattern", ("pattern",)),
                           ("check_type", ("type", "format"))):
    def _make(validators):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return findings(spark, sf_dir, validators=validators)
        return run
    query(_name, findings_sql(validators=_validators))(_make(_validators))


# --- check_long_form ---------------------------------------------------------------
# The same dictionary checks through the map form (J5): every checked node's
# records with their properties as one map of texts. Its oracle is the compiled
# path's SQL, so the two implementations agree.

_MAP_PROPS = {"customer": ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
              "orders": ["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
              "documents": ["text", "lang", "source", "n_chars", "quality"], "conversations": ["role", "text"]}


@query("check_long_form", findings_sql())
def check_long_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = None
    for node, props in _MAP_PROPS.items():
        part = checks.to_map(node_records(spark, sf_dir, node), node, ["submitter_id", *props])
        records = part if records is None else records.unionByName(part)
    return checks.findings_map(records, testdata_rules(spark), validation_id=VALIDATION_NEW,
                               schema_version=SCHEMA_VERSION)


# --- check_additional_keys ----------------------------------------------------------
# An event's record is {type, submitter_id, event_type, k}; the dictionary
# knows ``k`` for event-type nodes, so ``event_type`` is an additional key.

_EVENT_KNOWN = ("k", "submitter_id", "type")


@query("check_additional_keys", f"""
WITH r AS (
  SELECT 'event_' || CAST(event_id AS VARCHAR) AS submitter_id, 'events' AS study_id,
         to_json({{'type': event_type, 'submitter_id': 'event_' || CAST(event_id AS VARCHAR),
                  'event_type': event_type, 'k': CAST(json_extract_string(props, '$.k') AS BIGINT)}}) AS j
  FROM events
), k AS (SELECT submitter_id, study_id, unnest(json_keys(j)) AS key FROM r)
SELECT '{VALIDATION_NEW}' AS validation_id, CAST(NULL AS BIGINT) AS "index", 'event' AS node, study_id,
       'FAIL' AS validation_result, key AS invalid_key, 'event/additionalProperties' AS schema_path,
       'additionalProperties' AS validator, 'False' AS validator_value,
       'Additional properties are not allowed (''' || key || ''' was unexpected)' AS validation_error,
       '{SCHEMA_VERSION}' AS schema_version, submitter_id
FROM k WHERE key NOT IN ('k', 'submitter_id', 'type')
""")
def check_additional_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _additional(spark, sf_dir)


def _additional(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_records(spark, sf_dir)
    rec = F.to_json(F.struct(F.col("event_type").alias("type"), "submitter_id", "event_type",
                             F.col("k").cast("bigint").alias("k")), KEEP_NULLS)
    return checks.additional_properties(e, "event", rec, _EVENT_KNOWN, validation_id=VALIDATION_NEW,
                                        schema_version=SCHEMA_VERSION)


# --- unknown_node ---------------------------------------------------------------------

_DICT_NODES_SQL = ", ".join(_q(n) for n in TESTDATA_DICTIONARY if not n.startswith("_"))
_UNKNOWN_SQL = f"""
SELECT '{VALIDATION_NEW}' AS validation_id, CAST(NULL AS BIGINT) AS "index", event_type AS node,
       'events' AS study_id, 'ERROR' AS validation_result, CAST(NULL AS VARCHAR) AS invalid_key,
       CAST(NULL AS VARCHAR) AS schema_path, CAST(NULL AS VARCHAR) AS validator,
       CAST(NULL AS VARCHAR) AS validator_value,
       'node ''' || event_type || ''' not found in resolved schema' AS validation_error,
       '{SCHEMA_VERSION}' AS schema_version, 'event_' || CAST(event_id AS VARCHAR) AS submitter_id
FROM events WHERE event_type NOT IN ({_DICT_NODES_SQL})
"""


@query("unknown_node", _UNKNOWN_SQL)
def unknown_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unknown(spark, sf_dir)


def _unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = testdata_dictionary(spark)
    return checks.unknown_nodes(event_records(spark, sf_dir), d.nodes, validation_id=VALIDATION_NEW,
                                schema_version=SCHEMA_VERSION)


# --- validation_results ------------------------------------------------------------------
# Every finding of the run (all validators, all checked nodes), ERROR rows for
# unknown nodes, additional keys, broken event->customer links, and a PASS
# marker for each study of the run without a finding.

_EVENT_LINK_SQL = f"""
SELECT '{VALIDATION_NEW}' AS validation_id, CAST(NULL AS BIGINT) AS "index", 'event' AS node,
       'events' AS study_id, 'FAIL' AS validation_result, 'customers' AS invalid_key,
       'event/links/customers' AS schema_path, 'link' AS validator, 'customers' AS validator_value,
       'link ''customers'' target ''' || CAST(user_id AS VARCHAR) || ''' not found' AS validation_error,
       '{SCHEMA_VERSION}' AS schema_version, 'event_' || CAST(event_id AS VARCHAR) AS submitter_id
FROM events e WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey * 2 = e.user_id)
"""

def _all_findings_sql() -> str:
    from strata.plans.common import ORACLES
    parts = [findings_sql(), ORACLES["check_additional_keys"], _UNKNOWN_SQL, _EVENT_LINK_SQL]
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


_STUDIES_SQL = f"""
SELECT DISTINCT study_id FROM ({_RECORDS_SQL['customer']})
UNION SELECT DISTINCT source FROM documents
UNION SELECT 'synthetic_dialogs'
UNION SELECT 'events'
"""


def _event_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_records(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("k"))
    return checks.link_findings(e, c, child_node="event", link_name="customers", child_fk="user_id",
                                parent_key="k", validation_id=VALIDATION_NEW, schema_version=SCHEMA_VERSION)


def _all_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.assemble_results([findings(spark, sf_dir), _additional(spark, sf_dir), _unknown(spark, sf_dir),
                                    _event_links(spark, sf_dir)])


def _studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (customer_records(spark, sf_dir).select("study_id")
            .union(table(spark, sf_dir, "documents").select(F.col("source").alias("study_id")))
            .union(spark.createDataFrame([("synthetic_dialogs",), ("events",)], "study_id string"))
            .distinct())


def _results_sql() -> str:
    f = _all_findings_sql()
    return f"""
WITH f AS ({f})
SELECT * FROM f
UNION ALL
SELECT '{VALIDATION_NEW}', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), s.study_id, 'PASS', NULL, NULL, NULL, NULL,
       NULL, '{SCHEMA_VERSION}', NULL
FROM ({_STUDIES_SQL}) s WHERE s.study_id NOT IN (SELECT study_id FROM f WHERE study_id IS NOT NULL)
"""


def validation_results_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Findings feed both the results and the PASS markers' anti-join; a
    # reliable checkpoint (shared checkpoint folder) computes them once and
    # cuts the lineage the gate would otherwise re-plan.
    f = _all_findings(spark, sf_dir).checkpoint(eager=True)
    marks = checks.pass_markers(_studies(spark, sf_dir), f, validation_id=VALIDATION_NEW,
                                schema_version=SCHEMA_VERSION)
    return checks.assemble_results([f, marks])


query("validation_results", _results_sql())(validation_results_frame)


# --- pass_markers ---------------------------------------------------------------------------
# Regions are the studies; the run checks customer balances only. A region
# with no customer below the minimum gets a PASS marker.

@query("pass_markers", f"""
WITH s AS (SELECT lower(regexp_replace(r_name, '[^A-Za-z]', '', 'g')) AS study_id FROM region),
f AS ({findings_sql(nodes=('customer',), validators=('minimum',))})
SELECT '{VALIDATION_NEW}' AS validation_id, CAST(NULL AS BIGINT) AS "index", CAST(NULL AS VARCHAR) AS node,
       study_id, 'PASS' AS validation_result, CAST(NULL AS VARCHAR) AS invalid_key,
       CAST(NULL AS VARCHAR) AS schema_path, CAST(NULL AS VARCHAR) AS validator,
       CAST(NULL AS VARCHAR) AS validator_value, CAST(NULL AS VARCHAR) AS validation_error,
       '{SCHEMA_VERSION}' AS schema_version, CAST(NULL AS VARCHAR) AS submitter_id
FROM s WHERE study_id NOT IN (SELECT study_id FROM f)
""")
def pass_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.plans.common import region_studies
    f = findings(spark, sf_dir, nodes=("customer",), validators=("minimum",))
    return checks.pass_markers(region_studies(spark, sf_dir), f, validation_id=VALIDATION_NEW,
                               schema_version=SCHEMA_VERSION)


# --- two runs: error_summary, latest_validation ------------------------------------------------

def two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older run: customer and documents; newer run: customer and orders."""
    old = findings(spark, sf_dir, nodes=("customer", "documents"), validation_id=VALIDATION_OLD)
    new = findings(spark, sf_dir, nodes=("customer", "orders"), validation_id=VALIDATION_NEW)
    return old.unionByName(new)


_TWO_RUNS_SQL = (f"({findings_sql(nodes=('customer', 'documents'), validation_id=VALIDATION_OLD)})\nUNION ALL\n"
                 f"({findings_sql(nodes=('customer', 'orders'), validation_id=VALIDATION_NEW)})")


@query("error_summary", f"""
WITH r AS ({_TWO_RUNS_SQL})
SELECT node, validation_error, CAST(count(*) AS BIGINT) AS n FROM r
WHERE validation_id = (SELECT max(validation_id) FROM r) AND validation_error IS NOT NULL
GROUP BY 1, 2 ORDER BY 3 DESC
""")
def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.error_summary(two_runs(spark, sf_dir))


@query("latest_validation", f"""
WITH r AS ({_TWO_RUNS_SQL})
SELECT study_id, max(validation_id) AS validation_id FROM r GROUP BY study_id
""")
def latest_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    artifacts = two_runs(spark, sf_dir).select("study_id", "validation_id")
    return gate.latest_validation_per_study(artifacts)


# --- gate_signatures --------------------------------------------------------------------------

def _gate_sql(results_sql: str) -> str:
    ignored = " OR ".join(f"coalesce(validation_error, '') LIKE {_q(p)}" for p in gate.DEFAULT_IGNORED_ERRORS)
    return f"""
WITH r AS ({results_sql})
SELECT study_id, node, validator, invalid_key, validation_error, CAST(count(*) AS BIGINT) AS n
FROM r
WHERE validation_id = (SELECT max(validation_id) FROM r)
  AND validation_result <> 'PASS'
  AND NOT ({ignored})
  AND coalesce(study_id, '') NOT LIKE '%synthetic%'
GROUP BY ALL
"""


query("gate_signatures", _gate_sql(_results_sql()))(
    lambda spark, sf_dir: gate.gate_signatures(validation_results_frame(spark, sf_dir)))


# --- flagship_gate -------------------------------------------------------------------------------
# The minimum slice end to end: customer deposited twice (batch B re-deposits
# the BUILDING segment), landed as bronze text with provenance and row hash,
# promoted newest-per-hash, shaped to silver, checked against the dictionary,
# results with PASS markers, and the gate's failure signatures.

_FLAG_RULES = ("required", "type", "enum", "minimum", "pattern")


def flagship_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    file = F.concat(F.lit("submissions/nation"), F.col("c_nationkey"), F.lit("/customer.xlsx"))

    def deposit(df, batch, at):
        return landing.bronze_from_table(df, file=file, sheet="customer", row=F.col("c_custkey") + 3,
                                         study_id=F.concat(F.lit("nation"), F.col("c_nationkey").cast("string")),
                                         batch_id=batch, ingested_at=at, provenance=PROVENANCE)
    bronze = deposit(c, BATCH_A, INGESTED_A).unionByName(
        deposit(c.filter(F.col("c_mktsegment") == "BUILDING"), BATCH_B, INGESTED_B))
    silver = promote.silver_shape(promote.dedupe_bronze(bronze), [
        ("c_custkey", "c_custkey", "bigint"), ("c_name", "c_name", None),
        ("c_nationkey", "c_nationkey", "int"), ("c_acctbal", "c_acctbal", "double"),
        ("c_mktsegment", "c_mktsegment", None)])
    records = silver.join(nation_studies(spark, sf_dir), silver.c_nationkey == F.col("n_nationkey")) \
        .withColumn("submitter_id", F.concat(F.lit("customer_"), F.col("c_custkey")))
    rules = [r for r in testdata_rules(spark) if r.validator in _FLAG_RULES]
    f = checks.findings_for_node(records, "customer", rules, validation_id=VALIDATION_NEW,
                                 schema_version=SCHEMA_VERSION)
    marks = checks.pass_markers(records.select("study_id"), f, validation_id=VALIDATION_NEW,
                                schema_version=SCHEMA_VERSION)
    return gate.gate_signatures(checks.assemble_results([f, marks]))


query("flagship_gate", _gate_sql(findings_sql(nodes=("customer",), validators=_FLAG_RULES)))(flagship_gate)
