import glob
import hashlib

import pytest
import zstandard

from strata.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h.example/{i}", f"<p>{i % 7}</p>" * 200) for i in range(60)]
    rows += [(90, None, None), (91, "no scheme \r\n\tx", ""), (92, "u", "é" * 499), (93, "u", "é" * 499),
             (94, "u", "é" * 500), (95, "u", "é" * 500), (96, "u", "x" * 3_000_000), (None, "u", "é" * 500)]
    rows += [(59, "http://h.example/59", "<p>3</p>" * 200)]  # a repeated row that is its payload's last
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'own' as d", "'own' as last", "'own' as refers_to", "1 as payload_bytes")


def _expected(rows):
    last = {}
    for r in rows:
        h = (r.html or "").encode()
        if len(h) >= 1000 and r.page_id is not None:
            last[h] = max(last.get(h, r.page_id), r.page_id)
    out = []
    for r in rows:
        h = (r.html or "").encode()
        to = last.get(h)
        to = None if to == r.page_id else to
        out.append((r.page_id, len(h), hashlib.sha1(h).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip(spark, pages, tmp_dir):
    warc.write_bundles(pages, tmp_dir + "/w")
    back = warc.read_bundles(spark, tmp_dir + "/w").collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) \
        == _expected(pages.collect())
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert all(bytes(r.payload) == html[r.page_id] for r in back if r.record_type == "response")


def test_bundles_are_plain_zstandard_and_seekable(spark, pages, tmp_dir, monkeypatch):
    warc.write_bundles(pages, tmp_dir + "/w")
    n = 0
    for f in glob.glob(tmp_dir + "/w/part-*"):
        data = open(f, "rb").read()
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        entries = list(warc.records(data))
        assert b"".join(raw for _, raw in entries) == plain
        assert sum(size for *_, size in warc.seek_table(data)) == len(plain)
        n += len(entries)
    assert n == pages.count()


def test_fetch_reads_named_records(spark, pages, tmp_dir):
    warc.write_bundles(pages, tmp_dir + "/w")
    got = warc.fetch(spark, tmp_dir + "/w", [95, 96, 12345]).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in got) == [(95, 1000), (96, 3_000_000)]


def test_no_pages(spark, pages, tmp_dir):
    warc.write_bundles(pages.where("false"), tmp_dir + "/w")
    assert warc.read_bundles(spark, tmp_dir + "/w").count() == 0
