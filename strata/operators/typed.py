"""Dictionary validation of JSON records by their own types (V2-V5, V8).

A node's schema is compiled into one expression over its VARIANT records that
walks into objects and arrays: the types of values are JSON's, so the text
``"3"`` is no integer, a present ``null`` differs from a missing key, and a rule
inside a list is held against each item. All findings of a record come from one
pass, without a shuffle.

Keywords follow JSON schema: ``pattern`` and ``format`` speak of strings alone,
``minimum`` and ``maximum`` of numbers, ``minItems`` and ``items`` of arrays,
``required``, ``properties`` and ``additionalProperties`` of objects. A number
without a fraction is an integer however it is written. ``invalid_key`` is the
path of the value (``props.tags[2]``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.checks import empty_results, sql_lit
from strata.sources.records import path_literal

# How a type's values look in the engine's own type names.
_LIKE = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID", "object": "OBJECT%", "array": "ARRAY%"}
_NUMBER = "RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)'"
# Formats and the patterns that decide them (RFC 3339 date-time,
# the day itself is checked beside it; an address has one @ between two parts).
FORMATS = {
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "date-time": r"^\d{4}-\d{2}-\d{2}[Tt]([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$",
    "email": r"^[^@\s]+@[^@\s.]+(\.[^@\s.]+)*$",
    "uuid": r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
}
_DATED = ("date", "date-time")
_NONE = ("cast(array() as array<struct<invalid_key:string,validator:string,validator_value:string,schema_path:string,"
         "validation_error:string>>)")


def _get(v: str, kind: str, *names: str) -> str:
    return f"try_variant_get({v}, {path_literal(*names)}, '{kind}')"


def _is(v: str, kind: str, name: str) -> str:
    if name == "number":
        return f"{kind} {_NUMBER}"
    if name == "integer":
        n = _get(v, "double")
        return f"({kind} = 'BIGINT' OR ({kind} {_NUMBER} AND {n} % 1D = 0D))"
    return f"{kind} LIKE '{_LIKE[name]}'" if name in _LIKE else "false"


def _shown(v: str, kind: str) -> str:
    """A value as messages show it: text in quotes, null as None."""
    return (f"CASE WHEN {kind} = 'STRING' THEN concat('\\'', {_get(v, 'string')}, '\\'') WHEN {kind} = 'VOID' THEN 'None' "
            f"WHEN {kind} = 'BOOLEAN' THEN initcap(to_json({v})) ELSE to_json({v}) END")


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is made once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _joined(parts: list[str]) -> str:
    """Arrays of findings as one; null is no finding."""
    return f"concat({', '.join(f'coalesce({p}, {_NONE})' for p in parts)})"


class _Walk:
    """Compiles a schema; ``key`` and ``at`` are the value's path, as an SQL
    expression and as the schema's place. A value and its type are each bound
    to a name, so that they are made once however many rules speak of them."""

    def __init__(self, node: str):
        self.node, self.depth = node, 0

    def name(self, letter: str) -> str:
        self.depth += 1
        return f"{letter}{self.depth}"

    def finding(self, cond: str, key: str, at: str, validator: str, value: str | None, message: str) -> str:
        return (f"CASE WHEN {cond} THEN named_struct('invalid_key', {key}, 'validator', {sql_lit(validator)}, "
                f"'validator_value', {sql_lit(value)}, 'schema_path', {sql_lit(f'{at}/{validator}')}, "
                f"'validation_error', {message}) END")

    def value(self, v: str, schema: Mapping, key: str, at: str) -> Iterator[str]:
        """Arrays of findings of a value that is there (JSON null included);
        ``v`` is a name. What is no object or array is null as a map or list."""
        kind = self.name("t")
        own = list(self.own(v, kind, schema, key, at))
        if own:
            yield _let(kind, f"schema_of_variant({v})", f"array({', '.join(own)})")
        needed = [n for n in schema.get("required") or [] if isinstance(n, str)]
        if needed:
            missing = [self.finding(f"{_get(v, 'variant', n)} IS NULL AND {_get(v, 'map<string,variant>')} IS NOT NULL",
                                    self.below(key, n), at, "required", n, sql_lit(f"'{n}' is a required property")) for n in needed]
            yield f"array({', '.join(missing)})"
        known = schema.get("properties") or {}
        for name, inner in known.items():
            if isinstance(inner, Mapping):
                child = self.name("v")
                parts = list(self.value(child, inner, self.below(key, name), f"{at}/properties/{name}"))
                if parts:
                    yield _let(child, _get(v, "variant", name), f"CASE WHEN {child} IS NOT NULL THEN {_joined(parts)} END")
        if schema.get("additionalProperties") is False:
            yield self.additional(v, known, key, at)
        items = schema.get("items")
        if isinstance(items, Mapping):
            e, i = self.name("e"), self.name("i")
            parts = list(self.value(e, items, f"concat({key}, '[', {i}, ']')", f"{at}/items"))
            if parts:
                yield f"flatten(transform({_get(v, 'array<variant>')}, ({e}, {i}) -> {_joined(parts)}))"

    def below(self, key: str, name: str) -> str:
        return sql_lit(name) if key == "''" else f"concat({key}, {sql_lit('.' + name)})"

    def additional(self, v: str, known: Mapping, key: str, at: str) -> str:
        names = ", ".join(sql_lit(n) for n in known)
        extra = f"array_except(map_keys({_get(v, 'map<string,variant>')}), cast(array({names}) as array<string>))"
        k = self.name("k")
        path = k if key == "''" else f"concat({key}, '.', {k})"
        said = f"concat('Additional properties are not allowed (\\'', {k}, '\\' was unexpected)')"
        one = self.finding("true", path, at, "additionalProperties", "False", said)
        return f"transform({extra}, {k} -> {one})"

    def own(self, v: str, kind: str, schema: Mapping, key: str, at: str) -> Iterator[str]:
        shown = _shown(v, kind)

        def said(text: str) -> str:
            return f"concat({shown}, {sql_lit(text)})"

        def text(value) -> str:
            return value if isinstance(value, str) else json.dumps(value, separators=(",", ":"), ensure_ascii=False)
        if (types := schema.get("type")) is not None:
            names = [types] if isinstance(types, str) else list(types)
            bad = " AND ".join(f"NOT {_is(v, kind, n)}" for n in names) or "true"
            yield self.finding(bad, key, at, "type", text(types), said(" is not of type " + ", ".join(map(repr, names))))
        if (enum := schema.get("enum")) is not None:
            texts = ", ".join(sql_lit(x) for x in enum if isinstance(x, str)) or "CAST(NULL AS STRING)"
            others = [x for x in enum if not isinstance(x, str)]
            ok = [f"({kind} = 'STRING' AND coalesce({_get(v, 'string')} IN ({texts}), false))"]
            ok += [f"({kind} {_NUMBER} AND {_get(v, 'double')} = {float(x)!r}D)" for x in others
                   if isinstance(x, (int, float)) and not isinstance(x, bool)]
            ok += [f"({kind} <> 'STRING' AND to_json({v}) = {sql_lit(text(x))})" for x in others
                   if x is None or isinstance(x, (bool, list, dict))]
            yield self.finding(f"NOT ({' OR '.join(ok)})", key, at, "enum", text(enum), said(f" is not one of {list(enum)!r}"))
        for rule, op, word in (("minimum", "<", "less than the minimum"), ("maximum", ">", "greater than the maximum")):
            if (limit := schema.get(rule)) is not None:
                # Doubles decide; decimals tell numbers apart that are one double.
                n, most = _get(v, "double"), f"try_cast({sql_lit(text(limit))} AS double)"
                close = f"coalesce({_get(v, 'decimal(38,10)')} {op} try_cast({sql_lit(text(limit))} AS decimal(38,10)), false)"
                beyond = f"{n} {op}= {most} AND ({n} {op} {most} OR {close})"
                yield self.finding(f"{_is(v, kind, 'number')} AND ({beyond})", key, at, rule, text(limit), said(f" is {word} of {text(limit)}"))
        if (pattern := schema.get("pattern")) is not None:
            yield self.finding(f"{_is(v, kind, 'string')} AND NOT ({_get(v, 'string')} RLIKE {sql_lit(pattern)})", key, at, "pattern",
                               pattern, said(f" does not match {pattern!r}"))
        if (name := schema.get("format")) in FORMATS:
            s = _get(v, "string")
            ok = f"{s} RLIKE {sql_lit(FORMATS[name])}"
            if name in _DATED:
                # The day is held against its month's last: a day that is none
                # costs no exception.
                ok += (f" AND substr({s}, 1, 4) <> '0000' AND coalesce(try_cast(substr({s}, 9, 2) AS int) BETWEEN 1 AND "
                       f"day(last_day(try_cast(concat(substr({s}, 1, 7), '-01') AS date))), false)")
            yield self.finding(f"{_is(v, kind, 'string')} AND NOT ({ok})", key, at, "format", name, said(f" is not a {name!r}"))
        if (least := schema.get("minItems")) is not None:
            yield self.finding(f"{_is(v, kind, 'array')} AND size({_get(v, 'array<variant>')}) < {int(least)}", key, at, "minItems",
                               text(least), said(" is too short"))


def unchecked_formats(schemas: Mapping[str, Mapping]) -> list[tuple[str, str, str]]:
    """(node, place, format) of every ``format`` that is not checked: a
    dictionary that asks for one is told, rather than passed over."""
    out: list[tuple[str, str, str]] = []

    def walk(node: str, schema, at: str) -> None:
        if not isinstance(schema, Mapping):
            return
        if schema.get("format") is not None and schema["format"] not in FORMATS:
            out.append((node, at, str(schema["format"])))
        for name, inner in (schema.get("properties") or {}).items():
            walk(node, inner, f"{at}/properties/{name}")
        walk(node, schema.get("items"), f"{at}/items")
    for node, schema in schemas.items():
        walk(node, schema, node)
    return out


def node_findings(node: str, schema: Mapping, record: str = "record") -> str | None:
    """The findings of one record (an SQL array of structs), or None where the
    schema asks for nothing."""
    parts = list(_Walk(node).value(record, schema, "''", node))
    if not parts:
        return None
    return f"filter({_joined(parts)}, f -> f IS NOT NULL)"


def typed_findings(records: DataFrame, schemas: Mapping[str, Mapping], *, validation_id: str, schema_version: str) -> DataFrame:
    """Every violated rule of every record (node, study_id, index,
    submitter_id, record) is one FAIL row with the record's index; records of
    nodes without a schema give none here."""
    cases = " ".join(f"WHEN node = {sql_lit(n)} THEN {e}" for n, s in schemas.items() if (e := node_findings(n, s)))
    if not cases:
        return empty_results(records.sparkSession)
    found = records.filter("record IS NOT NULL").select("node", "study_id", "submitter_id", "index",
                                                        F.explode(F.expr(f"CASE {cases} END")).alias("f"))
    return found.select(
        F.lit(validation_id).alias("validation_id"), "index", "node", "study_id", F.lit("FAIL").alias("validation_result"),
        "f.invalid_key", "f.schema_path", "f.validator", "f.validator_value", "f.validation_error",
        F.lit(schema_version).alias("schema_version"), "submitter_id")
