"""Typed records: places, compiled schemas, rules by JSON's own types, links."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import jobs
from strata.operators import checks, links, typed
from strata.operators.positions import line_positions, ranked
from strata.plans.common import VALIDATION_NEW
from strata.plans.job_rows import _DICT, _nodes
from strata.plans.typed import link_records
from strata.sinks import writers
from strata.sources import records
from strata.sources.dictionary import dictionary_from_obj


def _parsed(spark, *lines):
    rows = [("n", "s", i, x) for i, x in enumerate(lines)]
    return records.parse_lines(spark.createDataFrame(rows, "node string, study_id string, index bigint, line string"))


def _found(spark, schema, *values):
    d = dictionary_from_obj(spark, {"n": schema})
    assert not d.ref_errors.count()
    got = typed.typed_findings(_parsed(spark, *[json.dumps(v) for v in values]), d.schemas, validation_id="v", schema_version="1")
    return sorted((r["index"], r.invalid_key, r.validator) for r in got.collect())


@pytest.mark.parametrize("kind, ok", [
    ("string", ["3", ""]), ("integer", [3, -3, 3.0, 10**25]), ("number", [3, 3.5, 1e300]), ("boolean", [True, False]),
    ("null", [None]), ("object", [{}, {"a": 1}]), ("array", [[], [1]])])
def test_a_type_takes_its_own_values_alone(spark, kind, ok):
    every = ["3", "", 3, -3, 3.0, 10**25, 3.5, 1e300, True, False, None, {}, {"a": 1}, [], [1]]
    fits = [json.dumps(v) for v in ok] + ([json.dumps(v) for v in (3, -3, 3.0, 10**25, 1e300)] if kind in ("integer", "number") else [])
    got = _found(spark, {"properties": {"x": {"type": kind}}}, *[{"x": v} for v in every])
    assert got == [(i, "x", "type") for i, v in enumerate(every) if json.dumps(v) not in fits]


def test_rules_walk_into_objects_and_lists(spark):
    schema = {"required": ["a"], "additionalProperties": False, "properties": {
        "a": {"type": "object", "required": ["b"], "properties": {"b": {"type": "array", "minItems": 1, "items": {
            "type": ["object", "null"], "properties": {"c": {"items": {"type": "integer", "maximum": 5}}}}}}},
        "o'k": {"pattern": "^x"}, 'q"q': {"enum": [1, None, True, "t", [1]]}}}
    got = _found(spark, schema, {"a": {"b": [{"c": [1, 9, "2"]}, None, 7]}}, {}, {"a": {}}, {"a": {"b": []}}, {"a": {"b": "no list"}},
                 {"a": {"b": [None]}, "o'k": "y", 'q"q': 2}, {"a": {"b": [None]}, "o'k": 5, 'q"q': 1.0},
                 *[{"a": {"b": [None]}, 'q"q': v} for v in (None, True, "t", [1], "1", False)], {"a": {"b": [{}]}, "z": 1})
    assert got == [(0, "a.b[0].c[1]", "maximum"), (0, "a.b[0].c[2]", "type"), (0, "a.b[2]", "type"), (1, "a", "required"),
                   (2, "a.b", "required"), (3, "a.b", "minItems"), (4, "a.b", "type"), (5, "o'k", "pattern"), (5, 'q"q', "enum"),
                   (11, 'q"q', "enum"), (12, 'q"q', "enum"), (13, "z", "additionalProperties")]


@pytest.mark.parametrize("name, good, bad", [
    ("date", ["2024-02-29"], ["2023-02-29", "2024-2-9", "x"]),
    ("date-time", ["2024-02-29T23:59:60Z", "2024-01-01t00:00:00.5+09:30"], ["2024-01-01", "2024-01-01T24:00:00Z", "2024-01-01T00:00:00"]),
    ("email", ["a@b", "a.b@c.de"], ["a@", "@b", "a b@c", "a@b@c", "plain"]),
    ("uuid", ["00000000-0000-0000-0000-00000000000F"], ["00000000", "g0000000-0000-0000-0000-000000000000"])])
def test_formats(spark, name, good, bad):
    got = _found(spark, {"properties": {"x": {"format": name}}}, *[{"x": v} for v in [*good, *bad, 5, None]])
    assert [i for i, *_ in got] == list(range(len(good), len(good) + len(bad)))


def test_a_format_that_is_not_checked_is_told(spark):
    d = dictionary_from_obj(spark, {"n": {"properties": {"x": {"items": {"format": "hostname"}}, "y": {"format": "date"}}}})
    assert typed.unchecked_formats(d.schemas) == [("n", "n/properties/x/items", "hostname")]


def test_refs_are_resolved_at_depth_and_circles_told(spark):
    d = dictionary_from_obj(spark, {"_definitions": {"k": {"type": "integer", "maximum": 5}, "t": {"properties": {"t": {"$ref": "#/_definitions/t"}}}},
                                    "n": {"properties": {"x": {"items": {"$ref": "#/_definitions/k", "minimum": 1.5}}, "t": {"$ref": "#/_definitions/t"}}}})
    assert d.schemas["n"]["properties"]["x"] == {"items": {"type": "integer", "maximum": 5, "minimum": 1.5}}
    assert any("circular" in r.error for r in d.ref_errors.collect())


def test_lines_that_are_no_records(spark):
    lines = ['{"submitter_id":"a"}', '{"submitter_id":"b"', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1} x', "[1]", "3", "null", "", ' {"a":2} ']
    got = {r["index"]: r for r in _parsed(spark, *lines).collect()}
    assert [bool(got[i].bad) for i in range(10)] == [False, True, True, True, True, True, True, True, True, False]
    assert got[0].submitter_id == "a" and got[1].submitter_id is None and got[9].record is not None


def test_compiled_types(spark):
    d = dictionary_from_obj(spark, {"n": {"properties": {
        "i": {"type": "integer"}, "s": {"type": ["null", "string"]}, "e": {"enum": ["a", None]}, "u": {"type": ["string", "integer"]},
        "l": {"type": "array", "items": {"type": "number"}}, "o": {"type": "object", "properties": {"b": {"type": "boolean"}}}, "any": {}}}})
    kind = records.record_type(d.schemas["n"])
    assert isinstance(kind, StructType) and kind.simpleString() == \
        "struct<i:bigint,s:string,e:string,u:variant,l:array<double>,o:struct<b:boolean>,any:variant>"
    parsed = _parsed(spark, '{"i":"3","s":3,"l":[1,2.5],"o":{"b":true},"any":null}', '{"i":4,"s":null,"l":"x","o":[]}')
    a, b = records.typed_columns(parsed, d.schemas["n"], links=("p",)).orderBy("index").collect()
    assert (a.i, a.s, a.l, a.o.b, a.untyped, a.p) == (None, None, [1.0, 2.5], True, ["i", "s"], None)
    assert (b.i, b.s, b.l, b.untyped) == (4, None, None, ["l", "o"])


def test_index_over_files_and_splits(spark, tmp_dir):
    # Small splits: one file is read by several tasks, and files share a task.
    rows = spark.range(3000).select(F.col("id").cast("string").alias("v"), F.when(F.col("id") % 3 == 0, F.lit(" ")).otherwise(F.lit("")).alias("b"))
    rows.repartitionByRange(4, F.col("v").cast("long")).sortWithinPartitions(F.col("v").cast("long")) \
        .select(F.concat("v", "b").alias("value")).write.text(f"{tmp_dir}/x")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = spark.read.text(f"{tmp_dir}/x").withColumn("one", F.lit(1))
        got = line_positions(lines, within=["one"])
        assert got.where("index <> cast(trim(value) as long)").count() == 0 and got.count() == 3000
        per_file = line_positions(lines)
        assert per_file.groupBy("index").count().agg(F.max("count")).first()[0] == 4
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_ranked_is_row_number(spark):
    df = spark.range(0, 2000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("g"))
    got = ranked(df, ["k"], ["g"], "i")
    want = {g: sorted(r.k for r in df.collect() if r.g == g) for g in (None, 0, 1)}
    assert {g: [k for _, k in sorted((r.i, r.k) for r in got.collect() if r.g == g)] for g in want} == want
    assert [sorted(r.i for r in got.collect() if r.g == g) for g in want] == [list(range(len(want[g]))) for g in want]


def test_one_pass_gives_the_rows_of_one_join_a_link(spark):
    sf = "/root/testdata/sf0.001"
    d = dictionary_from_obj(spark, _DICT)
    all_links = d.links.collect()
    keep = {"validation_id": VALIDATION_NEW, "schema_version": "1"}
    nodes = _nodes(spark, sf)
    want = checks.assemble_results([p for n in nodes for p in checks.dictionary_links(nodes, n, [x for x in all_links if x.child == n], **keep)])
    got = links.link_findings(link_records(spark, sf), all_links, **keep)
    cols = ["node", "study_id", "submitter_id", "invalid_key", "schema_path", "validator", "validator_value", "validation_error"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
    plan = links.missing_targets(link_records(spark, sf), all_links)._jdf.queryExecution().executedPlan().toString()
    own = plan[plan.index("HashAggregate"):]
    assert own.count("Exchange hashpartitioning(t#") + own.count("Exchange hashpartitioning(target#") + own.count("Exchange hashpartitioning(_groupingexpression#") == 1


def test_links_in_every_form_and_unset_ones(spark):
    d = dictionary_from_obj(spark, {"p": {"properties": {}}, "n": {"properties": {}, "links": [
        {"name": "ps", "target_type": "p", "required": True}, {"subgroup": [{"name": "a", "target_type": "p"}, {"name": "b", "target_type": "p"}], "required": True}]}})
    rows = [("p", '{"submitter_id":"1"}'), ("n", '{"submitter_id":"x","ps":{"submitter_id":"1"},"a":"1"}'),
            ("n", '{"submitter_id":"y","ps_submitter_id":"2","b":1}'), ("n", '{"submitter_id":"z","ps":null}')]
    parsed = records.parse_lines(spark.createDataFrame([(n, "s", 0, x) for n, x in rows], "node string, study_id string, index bigint, line string"))
    got = links.link_findings(parsed, d.links.collect(), validation_id="v", schema_version="1").collect()
    assert sorted((r.submitter_id, r.invalid_key, r.validator) for r in got) == [("y", "ps", "link"), ("z", "a", "required"), ("z", "ps", "required")]


def test_validate_dump_of_a_broken_dictionary_and_of_nothing(spark, tmp_dir):
    good = dictionary_from_obj(spark, {"_version": "1", "n": {"properties": {"x": {"format": "hostname"}}}})
    spark.createDataFrame([("s", "v1", "silver_s_n", "1", '{"submitter_id":"a"}')], "study_id string, validation_id string, table_name string, snapshot_id string, value string") \
        .write.partitionBy(*records.LINE_KEY).text(f"{tmp_dir}/d/validation")
    assert jobs.validate_dump(spark, f"{tmp_dir}/d", "v0", good, results_path=f"{tmp_dir}/r") is None
    with pytest.raises(ValueError, match="hostname"):
        jobs.validate_dump(spark, f"{tmp_dir}/d", "v1", good, results_path=f"{tmp_dir}/r")
    got = writers.read_results(spark, f"{tmp_dir}/r").collect()
    assert [(r.study_id, r.validation_result) for r in got] == [("s", "ERROR")]


def test_text_columns_infer_nothing(spark):
    from strata.sources.records import parse_lines, text_columns
    lines = ['{"submitter_id": "a", "n": "3", "o": {"x": [1]}, "b.c": true}', '{"submitter_id": "b", "n": 4, "o": null}', '{"n": 1', "[]"]
    df = spark.createDataFrame([("s", v) for v in lines], "study_id string, line string").withColumn("node", F.lit("visit"))
    got = text_columns(parse_lines(df))
    rows = {r.submitter_id: r for r in got["visit"].collect()}
    assert list(got) == ["visit"] and got["visit"].columns == ["study_id", "submitter_id", "b.c", "n", "o"]
    assert tuple(rows["a"]) == ("s", "a", "true", "3", '{"x":[1]}') and tuple(rows["b"]) == ("s", "b", None, "4", None)
    assert len(rows) == 2 and text_columns(parse_lines(df.limit(0))) == {}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_parsed_once_whatever_reads_the_record(spark):
    lines = spark.createDataFrame([("n", "s", 0, '{"submitter_id":"a","x":[{"y":"2024-02-30"},7]}')],
                                  "node string, study_id string, index bigint, line string").repartition(2)
    d = dictionary_from_obj(spark, {"n": {"required": ["z"], "properties": {
        "x": {"items": {"type": "object", "properties": {"y": {"type": "string", "format": "date", "enum": ["u"]}}}}}}})
    found = typed.typed_findings(records.parse_lines(lines), d.schemas, validation_id="v", schema_version="1")
    assert sorted((r.invalid_key, r.validator) for r in found.collect()) == [
        ("x[0].y", "enum"), ("x[0].y", "format"), ("x[1]", "type"), ("z", "required")]
    plan = _plan(found)
    # Every value is taken out, and its type told, once.
    assert plan.count("parseJson") == 1 and plan.count("schemaOfVariant") == 2


def test_numbers_that_are_one_double_are_told_apart(spark):
    schema = {"properties": {"x": {"type": "number", "maximum": 9007199254740992}, "y": {"minimum": 0.5}}}
    got = _found(spark, schema, *[{"x": v} for v in (9007199254740992, 9007199254740993, 1e300, -1e300)], {"y": 0.5}, {"y": 0.25}, {"y": "0"})
    assert got == [(1, "x", "maximum"), (2, "x", "maximum"), (5, "y", "minimum")]


def test_links_are_taken_out_of_a_record_once(spark):
    d = dictionary_from_obj(spark, {"p": {"properties": {}}, "n": {"properties": {}, "links": [
        {"name": "ps", "target_type": "p", "required": True}, {"name": "qs", "target_type": "q"}]}, "q": {"properties": {}}})
    rows = [("p", '{"submitter_id":"1"}'), ("n", '{"submitter_id":"x","ps":"1","qs":"9"}'), ("n", '{"submitter_id":"y","ps":"2"}'),
            ("n", '{"submitter_id":"y","ps":"2"}'), ("n", '{"submitter_id":null}'), ("n", "{"), ("other", '{"submitter_id":"o"}')]
    parsed = records.parse_lines(spark.createDataFrame([(n, "s", i, x) for i, (n, x) in enumerate(rows)],
                                                       "node string, study_id string, index bigint, line string"))
    found = links.link_findings(parsed, d.links.collect(), validation_id="v", schema_version="1")
    assert sorted((r["index"], r.submitter_id, r.invalid_key, r.validator) for r in found.collect()) == [
        (2, "y", "ps", "link"), (3, "y", "ps", "link"), (4, None, "ps", "required")]
    assert "parseJson" not in _plan(found) and "VariantType" not in _plan(found)
