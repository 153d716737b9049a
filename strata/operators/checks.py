"""Dictionary validation as set-based constraint checks.

The rules table is metadata-sized, so it is collected once and compiled, per
node, into **one select**: an array of ``when(<violation>, struct(...))``
findings, filtered for non-null and exploded. One scan per node over all
studies, no shuffle, no Python per row. An enum of any length is one ``IN``
set. Records whose properties are only known at run time keep them as one map
column and meet the rules of their node in the same way.

What a value may be: a property the frame does not have is checked by
``required`` alone; a null value is a finding of ``required`` and ``type``
(unless the type list has "null"); text is read leniently (``3.0`` is an
integer, ``true`` a boolean); formats other than FORMATS are not checked.

Messages follow the wording of the common JSON-schema validators
(``'x' is a required property``, ``'v' is not one of [...]`` ...), so the gate's
LIKE patterns read naturally.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import qcol

# The results table layout, in order. ``submitter_id`` is added
# as the stable record key (a DataFrame has no row position; ``index`` stays
# null unless a caller has a total order).
RESULT_COLUMNS = (
    "validation_id", "index", "node", "study_id", "validation_result", "invalid_key",
    "schema_path", "validator", "validator_value", "validation_error", "schema_version",
    "submitter_id",
)
RESULT_SCHEMA = (
    "validation_id string, index bigint, node string, study_id string, validation_result string, "
    "invalid_key string, schema_path string, validator string, validator_value string, "
    "validation_error string, schema_version string, submitter_id string"
)
# The formats that are checked.
FORMATS = ("date", "date-time", "email")


@dataclass(frozen=True)
class Rule:
    node: str
    property: str
    validator: str
    value: str | None
    schema_path: str


def collect_rules(rules: DataFrame) -> list[Rule]:
    """The dictionary's rules, collected (metadata-sized)."""
    got = [Rule(r.node, r.property, r.validator, r.value, r.schema_path) for r in rules.collect()]
    return sorted(got, key=lambda r: (r.node, r.property, r.validator))


def _py_repr_list(values: Sequence[str | None]) -> str:
    return "[" + ", ".join("None" if v is None else "'" + v + "'" for v in values) + "]"


def _quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def sql_lit(s: str | None) -> str:
    """A Spark SQL string literal (backslash escapes are on by default)."""
    if s is None:
        return "CAST(NULL AS STRING)"
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _finding_sql(cond: str, rule: Rule, message: str, value_text: str | None) -> str:
    return (f"CASE WHEN {cond} THEN named_struct("
            f"'invalid_key', {sql_lit(rule.property)}, 'validator', {sql_lit(rule.validator)}, "
            f"'validator_value', {sql_lit(value_text)}, 'schema_path', {sql_lit(rule.schema_path)}, "
            f"'validation_error', {message}) END")


def type_names(value: str) -> list[str]:
    """The types of a ``type`` rule: one name, or a JSON list of names."""
    return list(json.loads(value)) if value.startswith("[") else [value]


def _type_text(value: str) -> str:
    names = type_names(value)
    return ", ".join(repr(n) for n in names)


def _is_type(text: str, name: str, kind: str) -> str:
    """SQL test of a non-null value. ``text`` is its text, ``kind`` the Spark
    type of its column; numbers, booleans, arrays and objects in text columns
    are read from the text."""
    if name == "number":
        return f"try_cast({text} AS DOUBLE) IS NOT NULL"
    if name == "integer":
        number = f"try_cast({text} AS DOUBLE)"
        return f"coalesce({text} RLIKE '^[+-]?[0-9]+$' OR {number} = floor({number}), false)"
    if name == "boolean":
        return f"lower({text}) IN ('true', 'false')"
    if name == "array":
        return "true" if kind.startswith("array") else f"from_json({text}, 'array<string>') IS NOT NULL" if kind == "string" else "false"
    if name == "object":
        return "true" if kind.startswith(("struct", "map")) else \
            f"(ltrim({text}) LIKE '{{%' AND from_json({text}, 'map<string,string>') IS NOT NULL)" if kind == "string" else "false"
    if name == "string":
        return "true" if kind in ("string", "date") or kind.startswith(("timestamp", "varchar", "char")) else "false"
    return "false"  # "null", or a name that is no type: no value has it


def _is_format(text: str, name: str) -> str:
    if name == "date":
        return f"(try_to_timestamp({text}, 'yyyy-MM-dd') IS NOT NULL AND length({text}) = 10)"
    if name == "date-time":
        return f"try_to_timestamp({text}) IS NOT NULL"
    return f"{text} LIKE '%@%'"


def _text_of(name: str, kind: str) -> str:
    c = _ident(name)
    return f"to_json({c})" if kind.startswith(("array", "struct", "map")) else f"CAST({c} AS STRING)"


def _rule_sql(kinds: Mapping[str, str], rule: Rule) -> str | None:
    """One rule as a SQL CASE expression yielding a finding struct or null.
    Expressions are text so a node's whole rule set is parsed by the JVM in
    one call, instead of one round trip per Column function. ``kinds``: the
    frame's columns and their types."""
    v = rule.validator
    if rule.property not in kinds:
        return _finding_sql("true", rule, sql_lit(f"'{rule.property}' is a required property"), rule.property) \
            if v == "required" else None
    kind = kinds[rule.property]
    return _value_rule_sql(_ident(rule.property), _text_of(rule.property, kind), kind, rule)


def _value_rule_sql(c: str, text: str, kind: str, rule: Rule) -> str | None:
    v = rule.validator
    if v == "required":
        return _finding_sql(f"{c} IS NULL", rule, sql_lit(f"'{rule.property}' is a required property"),
                            rule.property)
    if v == "enum":
        values = json.loads(rule.value)
        allowed = ", ".join(sql_lit(x) for x in values if x is not None) or "CAST(NULL AS STRING)"
        msg = f"concat('\\'', {text}, {sql_lit(chr(39) + ' is not one of ' + _py_repr_list(values))})"
        return _finding_sql(f"{c} IS NOT NULL AND NOT coalesce({text} IN ({allowed}), false)", rule, msg, rule.value)
    if v in ("minimum", "maximum"):
        # Decimals tell close numbers apart, doubles reach beyond 28 digits;
        # rounding keeps order, so either test alone proves a violation.
        op, word = ("<", "less than the minimum") if v == "minimum" else (">", "greater than the maximum")
        beyond = " OR ".join(f"coalesce(try_cast({text} AS {t}) {op} try_cast({sql_lit(rule.value)} AS {t}), false)"
                             for t in ("DECIMAL(38,10)", "DOUBLE"))
        msg = f"concat(coalesce({text}, 'None'), {sql_lit(f' is {word} of {rule.value}')})"
        return _finding_sql(f"{c} IS NOT NULL AND ({beyond})", rule, msg, rule.value)
    if v == "pattern":
        msg = f"concat('\\'', {text}, {sql_lit(chr(39) + ' does not match ' + chr(39) + rule.value + chr(39))})"
        return _finding_sql(f"{c} IS NOT NULL AND NOT ({text} RLIKE {sql_lit(rule.value)})", rule, msg, rule.value)
    if v == "type":
        names = type_names(rule.value)
        ok = " OR ".join(_is_type(text, n, kind) for n in names)
        bad = f"{c} IS NOT NULL AND NOT ({ok})" if "null" in names else f"({c} IS NULL OR NOT ({ok}))"
        said = " is not of type " + _type_text(rule.value)
        msg = f"CASE WHEN {c} IS NULL THEN {sql_lit('None' + said)} ELSE concat('\\'', {text}, {sql_lit(chr(39) + said)}) END"
        return _finding_sql(bad, rule, msg, rule.value)
    if v == "format" and rule.value in FORMATS:
        msg = f"concat('\\'', {text}, {sql_lit(chr(39) + f' is not a {rule.value!r}')})"
        return _finding_sql(f"{c} IS NOT NULL AND NOT {_is_format(text, rule.value)}", rule, msg, rule.value)
    if v == "minItems":
        items = f"size({c})" if kind.startswith("array") else f"size(filter(split({text}, ';', -1), it -> trim(it) <> ''))"
        msg = f"concat(coalesce({text}, 'None'), ' is too short')"
        return _finding_sql(f"{c} IS NOT NULL AND {items} < {int(rule.value)}", rule, msg, rule.value)
    return None


def findings_for_node(df: DataFrame, node: str, rules: Iterable[Rule], *,
                      validation_id: str, schema_version: str,
                      key: str = "submitter_id", study: str = "study_id") -> DataFrame:
    """One pass over a node's records: every violated rule is one FAIL row."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    exprs = [e for e in (_rule_sql(kinds, r) for r in rules if r.node == node) if e is not None]
    if not exprs:
        return empty_results(df.sparkSession)
    found_expr = F.expr("filter(array(" + ", ".join(exprs) + "), f -> f IS NOT NULL)")
    found = df.select(F.col(key).cast("string").alias("submitter_id"), F.col(study).alias("study_id"),
                      F.explode(found_expr).alias("f"))
    return found.select(
        F.lit(validation_id).alias("validation_id"),
        F.lit(None).cast("bigint").alias("index"),
        F.lit(node).alias("node"),
        "study_id",
        F.lit("FAIL").alias("validation_result"),
        "f.invalid_key", "f.schema_path", "f.validator", "f.validator_value", "f.validation_error",
        F.lit(schema_version).alias("schema_version"),
        "submitter_id",
    )


def to_map(df: DataFrame, node: str, properties: Sequence[str], key: str = "submitter_id",
           study: str = "study_id") -> DataFrame:
    """Records -> (node, study_id, submitter_id, props): the properties of a
    record as one map of texts; a null value is an entry with a null."""
    pairs = [x for p in properties for x in (F.lit(p), qcol(p).cast("string"))]
    return df.select(F.lit(node).alias("node"), F.col(study).alias("study_id"),
                     F.col(key).cast("string").alias("submitter_id"),
                     (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("props"))


def findings_map(records: DataFrame, rules: Iterable[Rule], *, validation_id: str, schema_version: str) -> DataFrame:
    """The same checks for records (node, study_id, submitter_id, props)
    whose properties are only known at run time. Every record is checked on
    its own in one pass, without a shuffle: the rules are literals, and those
    of other nodes are skipped. A property that is not in the map, or null in
    it, fails ``required``; only one that is in it is checked by the others."""
    by_node: dict[str, list[str]] = {}
    for r in rules:
        value = f"element_at(props, {sql_lit(r.property)})"
        e = _value_rule_sql(value, value, "string", r)
        if e is None:
            continue
        if r.validator != "required":
            e = f"CASE WHEN map_contains_key(props, {sql_lit(r.property)}) THEN {e} END"
        by_node.setdefault(r.node, []).append(e)
    if not by_node:
        return empty_results(records.sparkSession)
    cases = " ".join(f"WHEN node = {sql_lit(n)} THEN filter(array({', '.join(es)}), f -> f IS NOT NULL)"
                     for n, es in by_node.items())
    found = records.select("node", "study_id", "submitter_id", F.explode(F.expr(f"CASE {cases} END")).alias("f"))
    return found.select(
        F.lit(validation_id).alias("validation_id"), F.lit(None).cast("bigint").alias("index"), "node", "study_id",
        F.lit("FAIL").alias("validation_result"), "f.invalid_key", "f.schema_path", "f.validator", "f.validator_value",
        "f.validation_error", F.lit(schema_version).alias("schema_version"), "submitter_id")


def additional_properties(df: DataFrame, node: str, record_json: Column, known: Sequence[str], *,
                          validation_id: str, schema_version: str, key: str = "submitter_id",
                          study: str = "study_id") -> DataFrame:
    """V5: keys of a record's JSON that the dictionary does not define, one
    finding per unexpected key."""
    known_arr = F.array(*[F.lit(k) for k in known]) if known else F.array().cast("array<string>")
    extra = df.select(F.col(key).cast("string").alias("submitter_id"), F.col(study).alias("study_id"),
                      F.explode(F.array_except(F.json_object_keys(record_json), known_arr)).alias("k"))
    return extra.select(
        F.lit(validation_id).alias("validation_id"), F.lit(None).cast("bigint").alias("index"),
        F.lit(node).alias("node"), "study_id", F.lit("FAIL").alias("validation_result"),
        F.col("k").alias("invalid_key"), F.lit(f"{node}/additionalProperties").alias("schema_path"),
        F.lit("additionalProperties").alias("validator"), F.lit("False").alias("validator_value"),
        F.concat(F.lit("Additional properties are not allowed ('"), F.col("k"),
                 F.lit("' was unexpected)")).alias("validation_error"),
        F.lit(schema_version).alias("schema_version"), "submitter_id")


def root_requirement(df: DataFrame, root_node: str, *, validation_id: str, schema_version: str,
                     link: str = "programs", key: str = "submitter_id", study: str = "study_id") -> DataFrame:
    """V6: records of the root node without the ``programs`` link get the
    root-requirement finding (ignored by the default gate policy)."""
    present = link in df.columns
    missing = F.col(link).isNull() if present else F.lit(True)
    return df.filter(missing).select(
        F.lit(validation_id).alias("validation_id"), F.lit(None).cast("bigint").alias("index"),
        F.lit(root_node).alias("node"), F.col(study).alias("study_id"), F.lit("FAIL").alias("validation_result"),
        F.lit(link).alias("invalid_key"), F.lit(f"{root_node}/required").alias("schema_path"),
        F.lit("required").alias("validator"), F.lit(link).alias("validator_value"),
        F.lit(f"'{link}' is a required property").alias("validation_error"),
        F.lit(schema_version).alias("schema_version"), F.col(key).cast("string").alias("submitter_id"))


def unknown_nodes(records: DataFrame, dictionary_nodes: DataFrame, *, validation_id: str,
                  schema_version: str, node: str = "node", key: str = "submitter_id",
                  study: str = "study_id") -> DataFrame:
    """V1: records whose ``type`` names a node the dictionary lacks -> ERROR."""
    dn = dictionary_nodes.select(F.col("node").alias("__n"))
    bad = records.join(dn, F.col(node) == F.col("__n"), "left_anti")
    index = F.col("index") if "index" in records.columns else F.lit(None)
    return bad.select(
        F.lit(validation_id).alias("validation_id"), index.cast("bigint").alias("index"),
        F.col(node).alias("node"), F.col(study).alias("study_id"), F.lit("ERROR").alias("validation_result"),
        F.lit(None).cast("string").alias("invalid_key"), F.lit(None).cast("string").alias("schema_path"),
        F.lit(None).cast("string").alias("validator"), F.lit(None).cast("string").alias("validator_value"),
        F.format_string("node '%s' not found in resolved schema", F.col(node)).alias("validation_error"),
        F.lit(schema_version).alias("schema_version"), F.col(key).cast("string").alias("submitter_id"))


def link_findings(child: DataFrame, parent: DataFrame, *, child_node: str, link_name: str, child_fk: str,
                  parent_key: str, validation_id: str, schema_version: str, key: str = "submitter_id",
                  study: str = "study_id") -> DataFrame:
    """A link whose target record does not exist -> FAIL."""
    p = parent.select(F.col(parent_key).alias("__pk"))
    bad = child.filter(F.col(child_fk).isNotNull()).join(p, F.col(child_fk) == F.col("__pk"), "left_anti")
    return bad.select(
        F.lit(validation_id).alias("validation_id"), F.lit(None).cast("bigint").alias("index"),
        F.lit(child_node).alias("node"), F.col(study).alias("study_id"), F.lit("FAIL").alias("validation_result"),
        F.lit(link_name).alias("invalid_key"), F.lit(f"{child_node}/links/{link_name}").alias("schema_path"),
        F.lit("link").alias("validator"), F.lit(link_name).alias("validator_value"),
        F.format_string("link '%s' target '%s' not found", F.lit(link_name),
                        F.col(child_fk).cast("string")).alias("validation_error"),
        F.lit(schema_version).alias("schema_version"), F.col(key).cast("string").alias("submitter_id"))


def link_columns(name: str) -> tuple[str, ...]:
    """Columns a link may stand in, the first that a frame has counts."""
    return (f"{name}.submitter_id", f"{name}_submitter_id", name)


def _finding_rows(df: DataFrame, node: str, *, invalid_key: Column, schema_path: Column, validator: str, value: Column,
                  message: Column, validation_id: str, schema_version: str) -> DataFrame:
    return df.select(
        F.lit(validation_id).alias("validation_id"), F.lit(None).cast("bigint").alias("index"), F.lit(node).alias("node"),
        "study_id", F.lit("FAIL").alias("validation_result"), invalid_key.alias("invalid_key"),
        schema_path.alias("schema_path"), F.lit(validator).alias("validator"), value.alias("validator_value"),
        message.alias("validation_error"), F.lit(schema_version).alias("schema_version"),
        F.col("submitter_id").cast("string").alias("submitter_id"))


def dictionary_links(records: Mapping[str, DataFrame], node: str, links: Sequence, *, validation_id: str,
                     schema_version: str) -> list[DataFrame]:
    """V9 over the dictionary's links of ``node`` (child, parent, name,
    required, subgroup): a required link that is null or has no column, a
    required subgroup none of whose links is set, and a link whose target is
    not among the parent's records. A parent that is not part of the run
    cannot be looked up and is not held against the child."""
    df, out = records[node], []
    keep = {"validation_id": validation_id, "schema_version": schema_version}

    def column(name: str) -> str | None:
        return next((c for c in link_columns(name) if c in df.columns), None)
    groups: dict[str, list[str]] = {}
    for link in links:
        at = column(link.name)
        if link.subgroup is not None:
            groups.setdefault(link.subgroup, []).append(link.name)
        if link.required:
            out.append(_finding_rows(
                df.filter(qcol(at).isNull()) if at else df, node, invalid_key=F.lit(link.name),
                schema_path=F.lit(f"{node}/links/{link.name}"), validator="required", value=F.lit(link.name),
                message=F.lit(f"'{link.name}' is a required property"), **keep))
        if at and link.parent in records:
            target = records[link.parent].select(F.col("submitter_id").cast("string").alias("__pk"))
            key = qcol(at).cast("string")
            out.append(_finding_rows(
                df.filter(qcol(at).isNotNull()).join(target, key == F.col("__pk"), "left_anti"), node,
                invalid_key=F.lit(link.name), schema_path=F.lit(f"{node}/links/{link.name}"), validator="link",
                value=F.lit(link.name),
                message=F.format_string("link '%s' target '%s' not found", F.lit(link.name), key), **keep))
    for group, names in groups.items():
        there = [qcol(c) for c in map(column, names) if c]
        listing = ", ".join(repr(n) for n in names)
        out.append(_finding_rows(
            df.filter(F.coalesce(*[c.cast("string") for c in there]).isNull()) if there else df, node,
            invalid_key=F.lit(names[0]), schema_path=F.lit(group), validator="required", value=F.lit(listing),
            message=F.lit(f"one of {listing} is a required property"), **keep))
    return out


#: Columns of a record that are not the dictionary's to name.
RECORD_COLUMNS = ("submitter_id", "study_id", "type", "snapshot_id", "validation_id", "table_name", "row_hash")


def additional_columns(df: DataFrame, node: str, known: Iterable[str], *, validation_id: str,
                       schema_version: str) -> DataFrame:
    """V5 on typed records: a value under a column that the dictionary does
    not define (bookkeeping columns aside) is a finding."""
    extra = sorted(c for c in df.columns if c not in set(known) and c not in RECORD_COLUMNS and not c.startswith("_"))
    if not extra:
        return empty_results(df.sparkSession)
    keys = F.filter(F.array(*[F.when(qcol(c).isNotNull(), F.lit(c)) for c in extra]), lambda c: c.isNotNull())
    each = df.select("submitter_id", "study_id", F.explode(keys).alias("k"))
    return _finding_rows(each, node, invalid_key=F.col("k"), schema_path=F.lit(f"{node}/additionalProperties"),
                         validator="additionalProperties", value=F.lit("False"),
                         message=F.concat(F.lit("Additional properties are not allowed ('"), F.col("k"), F.lit("' was unexpected)")),
                         validation_id=validation_id, schema_version=schema_version)


def error_rows(spark: SparkSession, failures: Sequence[tuple[str | None, BaseException]], *, validation_id: str | None,
               schema_version: str | None) -> DataFrame:
    """Infrastructure failures as one ERROR row a study (``Type:
    message``); the validation id is null when it cannot be recovered."""
    return spark.createDataFrame(
        [(validation_id, None, None, s, "ERROR", None, None, None, None, f"{type(e).__name__}: {e}", schema_version, None)
         for s, e in failures], RESULT_SCHEMA)


def error_row(spark: SparkSession, study_id: str, exc: BaseException, *, validation_id: str | None,
              schema_version: str | None) -> DataFrame:
    return error_rows(spark, [(study_id, exc)], validation_id=validation_id, schema_version=schema_version)


def pass_markers(studies: DataFrame, findings: DataFrame, *, validation_id: str,
                 schema_version: str, study: str = "study_id") -> DataFrame:
    """One PASS row for each study with no finding in this run, so the
    latest validation id always moves."""
    clean = studies.select(F.col(study).alias("study_id")).distinct() \
        .join(findings.select("study_id").distinct(), "study_id", "left_anti")
    return clean.select(
        F.lit(validation_id).alias("validation_id"), F.lit(None).cast("bigint").alias("index"),
        F.lit(None).cast("string").alias("node"), "study_id", F.lit("PASS").alias("validation_result"),
        *[F.lit(None).cast("string").alias(c) for c in ("invalid_key", "schema_path", "validator",
                                                         "validator_value", "validation_error")],
        F.lit(schema_version).alias("schema_version"), F.lit(None).cast("string").alias("submitter_id"))


def empty_results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT_SCHEMA)


def assemble_results(parts: Sequence[DataFrame]) -> DataFrame:
    """Findings, ERROR rows and PASS markers in one results frame."""
    out = parts[0].select(*RESULT_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*RESULT_COLUMNS))
    return out
