from pyspark.sql import functions as F

from strata.operators import checks, gate
from strata.sources.dictionary import dictionary_from_obj

DICT = {
    "_version": "2.0",
    "_definitions": {"num": {"type": "number", "minimum": 0}},
    "subject": {"required": ["submitter_id", "sex"],
                "properties": {"sex": {"enum": ["F", "M"]}, "age": {"$ref": "#/_definitions/num", "maximum": 120},
                               "code": {"pattern": "^S[0-9]+$"}, "dob": {"format": "date"},
                               "bad": {"$ref": "#/_definitions/missing"}}},
}


def _good_dict():
    import copy
    d = copy.deepcopy(DICT)
    del d["subject"]["properties"]["bad"]
    return d


def _records(spark):
    return spark.createDataFrame(
        [("s1", "st", "F", "30", "S1", "2020-01-01"), ("s2", "st", "X", "-1", "Q2", "2020-13-01"),
         ("s3", "st2", None, "130", "S3", None)],
        "submitter_id string, study_id string, sex string, age string, code string, dob string")


def test_dictionary_rules_refs_and_version(spark):
    d = dictionary_from_obj(spark, DICT, "dict.json")
    rules = {(r.property, r.validator): r.value for r in checks.collect_rules(d.rules)}
    assert rules[("age", "minimum")] == "0" and rules[("age", "maximum")] == "120"
    assert rules[("age", "type")] == "number"
    assert rules[("sex", "enum")] == '["F","M"]'
    errs = d.ref_errors.collect()
    assert len(errs) == 1 and "#/_definitions/missing" in errs[0].error and "dict.json" in errs[0].error
    assert d.version.first()[0] == "2.0"


def test_findings_one_row_per_violation(spark):
    d = dictionary_from_obj(spark, DICT)
    rules = checks.collect_rules(d.rules)
    f = checks.findings_for_node(_records(spark), "subject", rules, validation_id="v1", schema_version="2.0")
    got = sorted((r.submitter_id, r.validator, r.validation_error) for r in f.collect())
    assert ("s2", "enum", "'X' is not one of ['F', 'M']") in got
    assert ("s2", "minimum", "-1 is less than the minimum of 0") in got
    assert ("s2", "pattern", "'Q2' does not match '^S[0-9]+$'") in got
    assert ("s2", "format", "'2020-13-01' is not a 'date'") in got
    assert ("s3", "maximum", "130 is greater than the maximum of 120") in got
    assert ("s3", "required", "'sex' is a required property") in got
    assert not any(s == "s1" for s, _, _ in got)


def test_unknown_nodes_and_pass_markers(spark):
    d = dictionary_from_obj(spark, DICT)
    recs = spark.createDataFrame([("a", "st", "subject"), ("b", "st", "sample")],
                                 "submitter_id string, study_id string, node string")
    err = checks.unknown_nodes(recs, d.nodes, validation_id="v1", schema_version="2.0").collect()
    assert [(r.submitter_id, r.validation_result, r.validation_error) for r in err] == \
        [("b", "ERROR", "node 'sample' not found in resolved schema")]
    studies = spark.createDataFrame([("st",), ("clean",)], "study_id string")
    marks = checks.pass_markers(studies, checks.assemble_results([
        checks.unknown_nodes(recs, d.nodes, validation_id="v1", schema_version="2.0")]),
        validation_id="v1", schema_version="2.0").collect()
    assert [(r.study_id, r.validation_result) for r in marks] == [("clean", "PASS")]


def _results(spark, rows):
    return spark.createDataFrame(rows, checks.RESULT_SCHEMA)


def test_gate_latest_run_only_and_policy(spark):
    def row(vid, study, result, err, node="subject"):
        return (vid, None, node, study, result, "k", None, "enum", None, err, "1", "x")
    res = _results(spark, [
        row("v1", "a", "FAIL", "old failure"),
        row("v2", "a", "FAIL", "'X' is not one of ['F']"),
        row("v2", "a", "FAIL", None),
        row("v2", "b", "PASS", None, None),
        row("v2", "synthetic_x", "FAIL", "boom"),
        row("v2", "synth1", "FAIL", "boom"),
        row("v2", "a", "FAIL", "None is not of type 'string'"),
        row("v2", "a", "FAIL", "Additional properties are not allowed ('q' was unexpected)"),
        row("v2", None, "ERROR", "OSError: down"),
    ])
    sig = {(r.study_id, r.validation_error) for r in gate.gate_signatures(res).collect()}
    assert sig == {("a", "'X' is not one of ['F']"), ("a", None), ("synth1", "boom"), (None, "OSError: down")}
    only_errors = gate.gate_signatures(res, gate.GatePolicy(errors_only=True)).collect()
    assert [(r.study_id, r.validation_error) for r in only_errors] == [(None, "OSError: down")]
    clean = _results(spark, [row("v3", "a", "PASS", None, None)])
    assert gate.gate_signatures(res.unionByName(clean)).count() == 0
    summary = gate.error_summary(res).collect()
    assert summary[0].n >= summary[-1].n


def test_error_row_and_custom_check(spark):
    from strata.extend import StepRegistry, custom_check
    e = checks.error_row(spark, "st", OSError("download failed"), validation_id=None, schema_version="1")
    r = e.first()
    assert r.validation_result == "ERROR" and r.validation_error == "OSError: download failed"
    recs = _records(spark)
    f = custom_check(recs, node="subject", name="age_even", fails=(F.col("age").cast("int") % 2) != 0,
                     message=F.concat(F.lit("odd age "), F.col("age")), validation_id="v", schema_version="1")
    assert [x.submitter_id for x in f.collect()] == ["s2"]
    reg = StepRegistry()
    reg.register("mine", lambda df: df.limit(1))
    import pytest
    with pytest.raises(ValueError):
        reg.register("mine", lambda df: df)
    with pytest.raises(ValueError):
        reg.register("validate", lambda df: df)
    assert reg.run("mine", recs).count() == 1


def test_validate_job_writes_then_gates(spark, tmp_dir):
    import pytest
    from strata import jobs
    d = dictionary_from_obj(spark, _good_dict())
    recs = _records(spark)
    studies = recs.select("study_id").distinct()
    with pytest.raises(jobs.GateFailed) as err:
        jobs.validate(spark, {"subject": recs}, d, results_path=tmp_dir + "/results", studies=studies,
                      validation_id="v1", root_node="subject", policy_path=tmp_dir + "/policy",
                      csv_path=tmp_dir + "/csv")
    assert "st" in str(err.value)
    written = spark.read.parquet(tmp_dir + "/results")
    assert written.filter("validation_result = 'FAIL'").count() > 0
    assert written.filter("invalid_key = 'programs'").count() == 3  # root requirement, ignored by the gate
    assert spark.read.parquet(tmp_dir + "/policy").count() >= 3
    clean = recs.filter("submitter_id = 's1'")
    assert jobs.validate(spark, {"subject": clean}, d, results_path=tmp_dir + "/results",
                         studies=clean.select("study_id"), validation_id="v2").count() == 0
    empty = studies.filter("false")
    assert jobs.validate(spark, {"subject": recs}, d, results_path=tmp_dir + "/results2", studies=empty) is None


def test_validate_job_broken_ref_writes_error_rows_then_raises(spark, tmp_dir):
    import pytest
    from strata import jobs
    broken = dict(DICT)
    broken["subject"] = dict(DICT["subject"])
    d = dictionary_from_obj(spark, broken, "bad.json")
    recs = _records(spark)
    with pytest.raises(ValueError) as err:
        jobs.validate(spark, {"subject": recs}, d, results_path=tmp_dir + "/r", studies=recs.select("study_id"),
                      validation_id="v9")
    assert "#/_definitions/missing" in str(err.value) and "bad.json" in str(err.value)
    rows = spark.read.parquet(tmp_dir + "/r").collect()
    assert sorted(r.study_id for r in rows) == ["st", "st2"] and all(r.validation_result == "ERROR" for r in rows)


def test_map_form_matches_compiled_checks(spark):
    d = dictionary_from_obj(spark, _good_dict())
    rules = checks.collect_rules(d.rules)
    recs = _records(spark)
    recs = recs.unionByName(recs.filter("submitter_id = 's3'").withColumn("sex", F.lit("F")))  # a repeated id
    compiled = checks.findings_for_node(recs, "subject", rules, validation_id="v", schema_version="1")
    maps = checks.to_map(recs, "subject", ["submitter_id", "sex", "age", "code", "dob"])
    via_map = checks.findings_map(maps, rules, validation_id="v", schema_version="1")

    def key(df):
        return sorted(tuple(r) for r in df.select(*checks.RESULT_COLUMNS).collect())
    assert key(compiled) == key(via_map)
    assert "Exchange" not in via_map._jdf.queryExecution().executedPlan().toString()


def _errors(spark, schema, rows, columns):
    d = dictionary_from_obj(spark, {"_version": "1", **schema})
    df = spark.createDataFrame(rows, columns)
    f = checks.findings_for_node(df, "n", checks.collect_rules(d.rules), validation_id="v", schema_version="1")
    return sorted((r.submitter_id, r.invalid_key, r.validator) for r in f.collect()), d


def test_long_enum_and_null_in_enum(spark):
    many = [f"v{i}" for i in range(201)]
    got, _ = _errors(spark, {"n": {"properties": {"a": {"enum": many}, "b": {"enum": ["x", None]}}}},
                     [("1", "s", "v200", "x"), ("2", "s", "zzz", None), ("3", "s", None, "y")],
                     "submitter_id string, study_id string, a string, b string")
    assert got == [("2", "a", "enum"), ("3", "b", "enum")]


def test_type_names_lists_and_absent_properties(spark):
    props = {"i": {"type": "integer"}, "s": {"type": "string"}, "m": {"type": ["string", "null"]}, "absent": {"type": "string"},
             "a": {"type": "array"}, "o": {"type": "object"}, "z": {"type": ["integer", "boolean"]}}
    got, _ = _errors(spark, {"n": {"properties": props}}, [
        ("1", "s", "3.0", "x", None, "[1, 2]", '{"k": 1}', "true"),
        ("2", "s", "3.5", None, "y", "no", "[1]", "7"),
        ("3", "s", "1e3", "5", "y", "[]", "{}", "x")],
        "submitter_id string, study_id string, i string, s string, m string, a string, o string, z string")
    assert got == [("2", "a", "type"), ("2", "i", "type"), ("2", "o", "type"), ("2", "s", "type"), ("3", "z", "type")]
    got, _ = _errors(spark, {"n": {"properties": {"a": {"type": "array"}, "s": {"type": "string"}}}}, [("1", "s", ["x"], 5)],
                     "submitter_id string, study_id string, a array<string>, s int")
    assert got == [("1", "s", "type")]


def test_ranges_without_a_ceiling_and_formats(spark):
    props = {"x": {"maximum": 5, "minimum": -1e40}, "e": {"format": "email"}, "u": {"format": "uri"}, "t": {"format": "date-time"}}
    got, _ = _errors(spark, {"n": {"properties": props}}, [
        ("1", "s", "1e30", "a@b.org", "anything", "2020-01-01T00:00:00Z"), ("2", "s", "5.00000000001", "nobody", "x", "x"),
        ("3", "s", "5", None, None, None), ("4", "s", "-1e41", "a@b", "", "2020-01-01")],
        "submitter_id string, study_id string, x string, e string, u string, t string")
    assert got == [("1", "x", "maximum"), ("2", "e", "format"), ("2", "t", "format"), ("2", "x", "maximum"), ("4", "x", "minimum")]


def test_refs_through_refs_and_files(spark, tmp_dir):
    import json

    from strata.sources.dictionary import read_dictionary
    main = {"_version": "3", "_definitions": {"a": {"$ref": "#/_definitions/b", "maximum": 9}, "b": {"$ref": "terms.json#/deep/int"},
                                              "loop": {"$ref": "#/_definitions/loop"}},
            "n": {"properties": {"x": {"$ref": "#/_definitions/a"}, "y": {"$ref": "#/_definitions/loop"},
                                 "z": {"$ref": "terms.json#/deep/none"}},
                  "links": [{"name": "ps", "target_type": "p", "required": True},
                            {"required": True, "subgroup": [{"name": "qs", "target_type": "q"}, {"name": "bad", "target_type": "nowhere"}]},
                            {"name": "no target"}]},
            "p": {}, "q": []}
    terms = {"_terms": {}, "deep": {"int": {"type": "integer", "maximum": 3}}}
    for name, doc in (("main.json", main), ("terms.json", terms)):
        with open(f"{tmp_dir}/{name}", "w") as fh:
            json.dump(doc, fh)
    with open(f"{tmp_dir}/torn.json", "w") as fh:
        fh.write('{"half": ')
    d = read_dictionary(spark, tmp_dir)
    rules = {(r.property, r.validator): r.value for r in d.rules.filter("node = 'n'").collect()}
    assert rules == {("x", "type"): "integer", ("x", "maximum"): "9"}
    errors = sorted(r.error for r in d.ref_errors.collect())
    for part in ("circular", "terms.json#/deep/none", "torn.json", "unknown node 'nowhere'", "link without name", "'q' in main.json"):
        assert any(part in e for e in errors), part
    assert {(r.name, r.required, r.subgroup is not None) for r in d.links.collect()} == \
        {("ps", True, False), ("qs", False, True), ("bad", False, True)}
