"""Licence scan: identifier tags and notice phrases by Aho-Corasick, licence
expressions by a shunting-yard parser.

A text is brought to single-spaced lower-case words, and one automaton over
all notice phrases passes over it once. Where it meets an identifier tag, a
second automaton finds the tag in the text as written, and the expression that
follows on its line is parsed with ``or`` < ``and`` < ``with``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import query, table

# The phrases of the base scan and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notice phrases of licences beside the base ones.
NOTICES = {
    "mit licence": "mit", "permission is hereby granted free of charge": "mit",
    "apache licence": "apache", "apache software license": "apache",
    "general public licence": "gpl", "gnu gpl": "gpl",
    "lesser general public license": "lgpl", "lesser general public licence": "lgpl", "library general public license": "lgpl",
    "affero general public license": "agpl", "affero general public licence": "agpl",
    "bsd license": "bsd", "bsd licence": "bsd", "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl", "mozilla public licence": "mpl",
    "eclipse public license": "epl", "eclipse public licence": "epl",
    "isc license": "isc", "isc licence": "isc",
    "creative commons attribution": "cc-by", "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc", "cc by nc nd": "cc-by-nc", "cc0": "cc0", "public domain": "public-domain", "unlicense": "public-domain",
    "all rights reserved": "proprietary", "proprietary license": "proprietary",
}

# Licence identifiers up to their version, and their labels.
IDENTIFIERS = {
    "mit": "mit", "mit-0": "mit", "x11": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl",
    "bsd": "bsd", "0bsd": "bsd", "mpl": "mpl", "epl": "epl", "isc": "isc", "cc0": "cc0", "unlicense": "public-domain",
    "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-nc-sa": "cc-by-nc",
    "cc-by-nc-nd": "cc-by-nc", "zlib": "zlib", "unlicensed": "proprietary",
}

# How far a licence binds whoever uses the text, 0 to 1.
BINDS = {
    "public-domain": 0.0, "cc0": 0.0, "mit": 0.1, "isc": 0.1, "zlib": 0.1, "bsd": 0.1, "apache": 0.15, "cc-by": 0.2,
    "mpl": 0.4, "epl": 0.4, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.7, "agpl": 0.8, "cc-by-nd": 0.9, "cc-by-nc": 0.9,
    "proprietary": 1.0,
}

# What announces a licence expression, as written (lower case).
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:")
#: Each tag holds one of these words; only a text that does is read as written.
TAG_WORDS = ("license", "licence")

#: What a ``with`` exception takes off the binding of its licence.
EXCEPTION_RELIEF = 0.5

# ---------------------------------------------------------------- expressions

_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")
_RANK = {"or": 1, "and": 2, "with": 3}
_VERSION = re.compile(r"(-v?\d+(\.\d+)*)?(-clause|-only|-or-later)?\+?$")


def label_of(identifier: str) -> str | None:
    """``gpl-2.0-or-later`` -> ``gpl``; None for what is not known."""
    if identifier in IDENTIFIERS:
        return IDENTIFIERS[identifier]
    return IDENTIFIERS.get(_VERSION.sub("", identifier))


@dataclass
class Expression:
    """A licence expression: the labels it names and how far it binds."""
    labels: set[str]
    binds: float


def parse(text: str) -> Expression | None:
    """The longest expression that ``text`` (lower case) begins with, or None.

    ``or`` leaves the choice (the less binding side), ``and`` binds by both
    (the more binding one), ``with`` names an exception of the licence before
    it. ``with`` binds tighter than ``and``, that tighter than ``or``; equal
    operators group from the left. What follows a complete expression, such as
    a comment's end, is not read; an unclosed bracket, an operator without its
    right side or an unknown identifier end it before that point.
    """
    output: list[Expression] = []
    pending: list[str] = []
    best = None
    want_operand = True
    at = 0
    while True:
        while at < len(text) and text[at] in " \t":
            at += 1
        m = _TOKEN.match(text, at)
        token = m.group() if m else ""
        token = token.rstrip(".-")  # a sentence's end
        if want_operand:
            if token == "(":
                pending.append(token)
            elif pending and pending[-1] == "with":
                if not token or token in ("(", ")") or token in _RANK:
                    break
                output.append(Expression(set(), 0.0))
                want_operand = False
            else:
                label = label_of(token) if token and token not in _RANK else None
                if label is None:
                    break
                output.append(Expression({label}, BINDS[label]))
                want_operand = False
        elif token in _RANK:
            while pending and pending[-1] != "(" and _RANK[pending[-1]] >= _RANK[token]:
                _apply(output, pending.pop())
            pending.append(token)
            want_operand = True
        elif token == ")" and "(" in pending:
            while pending[-1] != "(":
                _apply(output, pending.pop())
            pending.pop()
        else:
            break
        at += len(token)
        if not want_operand and "(" not in pending:
            best = _whole(output, pending)
        if len(token) < len(m.group()):
            break
    return best


def _apply(output: list[Expression], op: str) -> None:
    right, left = output.pop(), output.pop()
    if op == "with":
        output.append(Expression(left.labels, left.binds * EXCEPTION_RELIEF))
    else:
        choose = min if op == "or" else max
        output.append(Expression(left.labels | right.labels, choose(left.binds, right.binds)))


def _whole(output: list[Expression], pending: list[str]) -> Expression:
    out = list(output)
    for op in reversed(pending):
        _apply(out, op)
    return out[0]


# ------------------------------------------------------------------- scanning


@dataclass
class Scan:
    """What a text holds: its word count, the base places (word, label), the
    labels and the binding of the strongest statement."""
    n_words: int = 0
    base: list[tuple[int, str]] = field(default_factory=list)
    labels: set[str] = field(default_factory=set)
    binds: float = 0.0


@lru_cache(maxsize=1)
def _automata():
    import ahocorasick
    notices, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE}.items():
        notices.add_word(f" {phrase} ", (len(phrase) + 2, label, phrase in BASE))
    for word in TAG_WORDS:
        notices.add_word(f" {word} ", (len(word) + 2, None, False))
    for tag in TAGS:
        tags.add_word(tag, len(tag))
    notices.make_automaton()
    tags.make_automaton()
    return notices, tags


_SPACED = bytes(b if b else 0x20 for b in W.ALNUM.tolist())
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _expressions(lower: str, tags) -> Iterator[Expression]:
    """The expressions that follow tags, up to the end of the line."""
    for end, size in tags.iter(lower):
        begin = end + 1 - size
        if begin and (lower[begin - 1].isalnum() or lower[begin - 1] in "-_"):
            continue  # the end of a longer word
        stop = lower.find("\n", end + 1)
        got = parse(lower[end + 1:stop if stop >= 0 else len(lower)])
        if got:
            yield got


def scan(raw: bytes) -> Scan:
    """Scan a UTF-8 text. A byte is a character to the automata, which hold
    ASCII alone, so any text passes without being decoded.

    A notice inside a longer one (``cc by`` in ``cc by nc``) says nothing of
    its own; the base phrases are found wherever they stand.
    """
    notices, tags = _automata()
    found = Scan()
    words = raw.translate(_SPACED).split()
    found.n_words = len(words)
    plain = (b" " + b" ".join(words) + b" ").decode("latin-1")
    tagged, spans = False, []
    for end, (size, label, is_base) in notices.iter(plain):
        if label is None:
            tagged = True
        else:
            spans.append((end + 1 - size, -end, label, is_base))
    word = at = reached = 0
    for begin, end, label, is_base in sorted(spans):
        if -end > reached:
            reached = -end
            found.labels.add(label)
            found.binds = max(found.binds, BINDS[label])
        if is_base:
            word += plain.count(" ", at, begin)
            at = begin
            found.base.append((word, label))
            found.labels.add(label)
    if tagged:
        for got in _expressions(raw.translate(_LOWER).decode("latin-1"), tags):
            found.labels |= got.labels
            found.binds = max(found.binds, got.binds)
    return found


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offsets in W.slices(batches, "text"):
        raw = buf.tobytes()
        got = [scan(raw[lo:hi]) for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        places = pa.array([[{"word": w, "label": x} for w, x in sorted(g.base)] for g in got],
                          pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())])))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array([g.n_words for g in got], pa.int64()), places,
             pa.array([sorted(g.labels) for g in got], pa.list_(pa.string())), pa.array([g.binds for g in got], pa.float64())],
            names=["doc_id", "n_words", "base", "labels", "score"])


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, base (the
    places of BASE phrases: first word and label, in order), labels (sorted; of
    phrases, notices and tagged expressions), score.

    ``score`` says how far what was found binds a user of the text: the
    strongest statement, from 0 (nothing found, or given up to the public) to 1
    (all rights reserved). Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with
    A-Z lower-cased.

    Null and empty texts and texts without words: no words, no places, no
    labels, score 0. A null doc_id is kept, repeated rows are all returned,
    further columns are ignored, an empty table gives no rows. One pass without
    a shuffle; a text of any length is scanned in time linear in it.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _scan_rows, "doc_id long, n_words long, base array<struct<word:long,label:string>>, labels array<string>, score double")


@query("op11_license_scan")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = license_scan(table(spark, sf_dir, "documents"))
    return got.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")
