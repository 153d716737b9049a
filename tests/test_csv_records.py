"""CSV records over several lines, held against Python's csv on whole files."""

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.sources import csv_records
from strata.sources.files import read_csv_tolerant

_CELLS = st.text(alphabet=st.sampled_from(list('ab,;"\n é')), max_size=8)


@pytest.fixture()
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _write(tmp_dir, name, text):
    with open(f"{tmp_dir}/{name}", "w", newline="") as fh:
        fh.write(text)
    return f"{tmp_dir}/{name}"


def _spelt(rows, **more):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", **more).writerows(rows)
    return out.getvalue()


def test_cells_of_any_text_over_small_splits(spark, small_splits, tmp_dir):
    @settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(_CELLS, _CELLS), min_size=20, max_size=40))
    def check(rows):
        text = _spelt([("k", "x", "y"), *[(i, *r) for i, r in enumerate(rows)]], quoting=csv.QUOTE_ALL)
        path = _write(tmp_dir, "f.csv", text)
        got = read_csv_tolerant(spark, [path], delimiter=",").collect()
        assert sorted((int(r.k), r.x or "", r.y or "", r._corrupt_record) for r in got) == [(i, x, y, None) for i, (x, y) in enumerate(rows)]
    check()


def test_states_of_lines_are_those_of_one_pass(spark, small_splits, tmp_dir):
    # Quotes at random places: states by a plain machine over the whole text.
    import random
    rng = random.Random(7)
    text = "".join(rng.choice('aaab,,""\n') for _ in range(4000)) + "\n"
    path = _write(tmp_dir, "q.csv", text)
    from strata.sources import files
    lines = files._lines(spark, [path], None).withColumn("delimiter", F.lit(","))
    assert lines.select("split").distinct().count() > 20
    got = {r["at"]: (r.before, r.after) for r in csv_records.quoted_lines(lines).collect()}
    state, want = 0, {}
    for i, line in enumerate(text.split("\n")[:-1]):
        before = state == 2
        state = 2 if before else 0
        for c in line:
            if c == '"':
                state = {0: 2, 1: 1, 2: 3, 3: 2}[state]
            elif state != 2:
                state = 0 if c == "," else 1
        if '"' in line:
            want[i] = before, state == 2
    assert got == want


def test_files_of_their_own_layouts_and_unclosed_quotes(spark, tmp_dir):
    a = _write(tmp_dir, "a.csv", 'k,v\n1,"x\n\ny ""z"""\nk,v\n2,"open\n3,c\n')
    b = _write(tmp_dir, "b.csv", "\n v ; k \r\n\"two\r\nlines; here\";4\r\n;5\r\n")
    c = _write(tmp_dir, "c.csv", "")
    got = {(r.k, r.v, r._corrupt_record) for r in read_csv_tolerant(spark, [a, b, c]).collect()}
    assert got == {("1", 'x\n\ny "z"', None), ("k", "v", None), (None, None, '2,"open'), (None, None, "3,c"),
                   ("4", "two\nlines; here", None), ("5", None, None)}
