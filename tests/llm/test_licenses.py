import re

import pytest
from brute import alnum

from strata.llm import licenses, queries
from strata.llm.licenses import BASE, BINDS, NOTICES, TAGS, label_of, parse, scan

_COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _descent(text):
    """(labels, binds) of the longest expression a text begins with, by
    recursive descent over the tokens of every prefix."""
    tokens = []
    for m in re.finditer(r"[ \t]*([()]|[a-z0-9][a-z0-9.+-]*)", text):
        if m.start() != (tokens[-1][1] if tokens else 0):
            break
        word = m.group(1).rstrip(".-")
        tokens.append((word, m.end()))
        if word != m.group(1):
            break
    words = [t for t, _ in tokens]

    class Bad(Exception):
        pass

    def run(ws):
        def peek():
            return ws[at[0]] if at[0] < len(ws) else None

        def take():
            at[0] += 1
            return ws[at[0] - 1]

        def either():
            got = both()
            while peek() == "or":
                take()
                other = both()
                got = got[0] | other[0], min(got[1], other[1])
            return got

        def both():
            got = excepted()
            while peek() == "and":
                take()
                other = excepted()
                got = got[0] | other[0], max(got[1], other[1])
            return got

        def excepted():
            got = single()
            while peek() == "with":
                take()
                if peek() in (None, "(", ")", "or", "and", "with"):
                    raise Bad
                take()
                got = got[0], got[1] * licenses.EXCEPTION_RELIEF
            return got

        def single():
            if peek() is None:
                raise Bad
            word = take()
            if word == "(":
                got = either()
                if peek() != ")":
                    raise Bad
                take()
                return got
            if word in ("or", "and", "with") or label_of(word) is None:
                raise Bad
            return {label_of(word)}, BINDS[label_of(word)]

        at = [0]
        got = either()
        if at[0] != len(ws):
            raise Bad
        return got

    for n in range(len(words), 0, -1):
        try:
            return run(words[:n])
        except Bad:
            continue
    return None


def brute(text):
    words = alnum(text)
    spans = []
    for phrase, label in {**NOTICES, **BASE}.items():
        p = phrase.split()
        spans += [(i, i + len(p), label, phrase in BASE) for i in range(len(words)) if words[i:i + len(p)] == p]
    told = [s for s in spans if not any(o[0] <= s[0] and s[1] <= o[1] and o[:2] != s[:2] for o in spans)]
    base = sorted((s[0], s[2]) for s in spans if s[3])
    labels = {s[2] for s in told} | {x for _, x in base}
    binds = [BINDS[s[2]] for s in told]
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for tag in TAGS:
        for m in re.finditer(rf"(?<![\w-]){re.escape(tag)}([^\n]*)", lower):
            got = _descent(m.group(1))
            if got:
                labels |= got[0]
                binds.append(got[1])
    return (len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
            ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), max(binds, default=0.0))


TEXTS = [
    "Released under the MIT License.", "mit\nlicense -- MIT (license) mit; the mit license mit license",
    "GNU Lesser General Public License, version 2", "Licensed under CC BY-NC 4.0. or cc by", "cc-by and CC BY SA",
    "SPDX-License-Identifier: MIT OR Apache-2.0", "// spdx-license-identifier: (GPL-2.0-only WITH Classpath-exception-2.0) AND MIT */",
    "License: GPL-3.0+ or (BSD-3-Clause and (MPL-2.0 or proprietary))", "license: MIT or", "license: MIT. Apache-2.0", "License: (MIT",
    "LICENCE: agpl-3.0 with x with y or isc", "license: ) mit", "sublicense: mit and re-license: mit", "license: unknown or mit",
    "License: MIT AND GPL-2.0 OR CC0-1.0\nlicense: mit and (gpl-2.0 or cc0-1.0)", "license:\nmit", "license: mit)(apache-2.0", "license: with mit",
    "été MIT Lïcense MIT License é", "mit license" * 3, "", None, " \x00 ", "the public domain; all rights reserved",
]


@pytest.mark.parametrize("text", TEXTS)
def test_scan_matches_plain_search_and_recursive_descent(spark, text):
    got = queries_columns(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert [tuple(r)[1:] for r in got] == [brute(text)]


def queries_columns(docs):
    old, licenses.table = licenses.table, lambda *a: docs
    try:
        return licenses.op11(docs.sparkSession, "").select(*_COLUMNS).collect()
    finally:
        licenses.table = old


def test_whole_table(spark, load):
    docs = load("documents")
    want = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=str)
    got = queries.REGISTRY["op11_license_scan"](spark, "/root/testdata/sf0.001").select(*_COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == want
    assert any(r.n_base for r in got)


def test_odd_documents(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    assert sorted(map(tuple, queries_columns(odd_docs)), key=str) == sorted(((r.doc_id, *brute(r.text)) for r in rows), key=str)
    assert queries_columns(no_docs) == []


def test_long_text_of_licences_is_linear():
    got = scan(("MIT License, " * 200_000).encode())
    assert got.n_words == 400_000 and len(got.base) == 200_000 and got.base[-1] == (399_998, "mit")


def test_precedence():
    assert parse("mit or gpl-2.0 and agpl-3.0").binds == BINDS["mit"]
    assert parse("(mit or gpl-2.0) and agpl-3.0").binds == BINDS["agpl"]
    assert parse("gpl-2.0 with classpath-exception-2.0").binds < BINDS["gpl"]
    assert parse("mit or") == parse("mit") and parse("(mit") is None and parse("") is None
    assert set(BASE.values()) | set(NOTICES.values()) | set(licenses.IDENTIFIERS.values()) <= set(BINDS)
