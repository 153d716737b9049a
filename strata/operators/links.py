"""All links of a run in one pass.

Every record says which keys it has and which it asks for; the tagged pairs
(target node, key) are brought together in one aggregate, whatever the number
of nodes and links, and what is asked for and not there is held against the
records that ask. Partial sums shrink a parent that a third of all records
name before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.checks import link_columns, sql_lit
from strata.session import written
from strata.sources.records import path_literal


def _key_sql(name: str) -> str:
    """The target's submitter_id that a record's link holds, as text: in an
    object under the link's name, beside it, or as the plain value."""
    tries = [path_literal(name, "submitter_id"), *[path_literal(c) for c in link_columns(name)[1:]]]
    plain = f"schema_of_variant(try_variant_get(record, {path_literal(name)}, 'variant')) NOT RLIKE '^(OBJECT|ARRAY|VOID)'"
    got = [f"try_variant_get(record, {p}, 'string')" for p in tries[:-1]]
    return f"coalesce({', '.join(got)}, CASE WHEN {plain} THEN try_variant_get(record, {tries[-1]}, 'string') END)"


def asked_links(links: Sequence) -> Column:
    """What a record (node, submitter_id, record) has and asks for: array of
    (name, target, key), first its own key without a name, then every link of
    its node in order; the key of a link that is not set is null."""
    own = "named_struct('name', cast(null as string), 'target', node, 'key', submitter_id)"
    cases = []
    for node, of in _by_node(links).items():
        each = ", ".join(f"named_struct('name', {sql_lit(x.name)}, 'target', {sql_lit(x.parent)}, 'key', {_key_sql(x.name)})" for x in of)
        cases.append(f"WHEN node = {sql_lit(node)} THEN array({own}, {each})")
    return F.expr(f"CASE {' '.join(cases)} ELSE array({own}) END" if cases else f"array({own})")


def _by_node(links: Sequence) -> dict[str, list]:
    out: dict[str, list] = {}
    for x in links:
        out.setdefault(x.child, []).append(x)
    return out


def missing_targets(records: DataFrame, links: Sequence) -> DataFrame:
    """(target, key) that some record asks for and no record is. Targets of
    which the run has no record at all cannot be looked up and are not held
    against anyone. One exchange, with partial aggregates before it."""
    return _missing(records.select(F.explode(asked_links(links)).alias("a")))


def _missing(asked: DataFrame) -> DataFrame:
    return asked.where("a.key IS NOT NULL").groupBy(F.col("a.target").alias("target"), F.col("a.key").alias("key")) \
        .agg(F.max(F.col("a.name").isNull()).alias("there")).where("NOT there").select("target", "key")


def link_findings(records: DataFrame, links: Sequence, *, validation_id: str, schema_version: str) -> DataFrame:
    """V9 for parsed records (node, study_id, index, submitter_id, record):
    required links that are not set, required subgroups none of whose links
    is, and links whose target is not there.

    A record is read and taken apart once: its keys go to the shared scratch
    folder, and everything after that reads those columns. Records are held
    against the missing keys of a target alone that has some."""
    there = F.col("record").isNotNull()
    taken = written(records.select("node", "study_id", "index", "submitter_id", there.alias("good"),
                                   F.when(there, asked_links(links)).alias("asked")), "links")
    present = [r.node for r in taken.select("node").distinct().collect()]  # nodes are few
    base = taken.where("good")
    each = base.select("node", "study_id", "index", "submitter_id", F.explode("asked").alias("a"))
    missing = written(_missing(each.where(F.col("a.target").isin(present))), "links")
    targets = [r.target for r in missing.select("target").distinct().collect()]
    asked = each.where(F.col("a.name").isNotNull() & F.col("a.target").isin(targets))
    broken = asked.join(missing, (F.col("a.target") == F.col("target")) & (F.col("a.key") == F.col("key")), "left_semi")
    out = broken.select("node", "study_id", "index", "submitter_id", F.col("a.name").alias("invalid_key"),
                        F.format_string("%s/links/%s", "node", "a.name").alias("schema_path"), F.lit("link").alias("validator"),
                        F.col("a.name").alias("validator_value"),
                        F.format_string("link '%s' target '%s' not found", "a.name", "a.key").alias("validation_error"))
    unset = _unset(links)
    if unset:
        cases = " ".join(f"WHEN node = {sql_lit(n)} THEN array({', '.join(es)})" for n, es in unset.items())
        rows = base.select("node", "study_id", "index", "submitter_id", F.explode(F.expr(f"CASE {cases} END")).alias("f")).where("f IS NOT NULL")
        out = out.unionByName(rows.select("node", "study_id", "index", "submitter_id", "f.invalid_key", "f.schema_path",
                                          F.lit("required").alias("validator"), F.col("f.validator_value"), "f.validation_error"))
    return out.withColumns({"validation_id": F.lit(validation_id), "validation_result": F.lit("FAIL"),
                            "schema_version": F.lit(schema_version)})


def _unset(links: Sequence) -> dict[str, list[str]]:
    """Per node, a CASE over ``asked`` per required link or subgroup that a
    record lacks."""
    out: dict[str, list[str]] = {}
    for node, of in _by_node(links).items():
        cases, groups = [], {}
        for at, x in enumerate(of, start=1):
            if x.subgroup is not None:
                groups.setdefault(x.subgroup, {})[at] = x.name
            if x.required:
                cases.append(_unset_sql([at], x.name, f"{node}/links/{x.name}", x.name, f"'{x.name}' is a required property"))
        for group, names in groups.items():
            listing = ", ".join(repr(n) for n in names.values())
            cases.append(_unset_sql([*names], next(iter(names.values())), group, listing, f"one of {listing} is a required property"))
        if cases:
            out[node] = cases
    return out


def _unset_sql(places: Sequence[int], key: str, path: str, value: str, message: str) -> str:
    cond = " AND ".join(f"get(asked, {at}).key IS NULL" for at in places)
    return (f"CASE WHEN {cond} THEN named_struct('invalid_key', {sql_lit(key)}, 'schema_path', {sql_lit(path)}, "
            f"'validator_value', {sql_lit(value)}, 'validation_error', {sql_lit(message)}) END")
