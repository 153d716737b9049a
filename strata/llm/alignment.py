"""Alignment of the tokens of two tokenizers over the bytes of a text.

Interval coalescing: all A and B tokens are lexsorted by their first byte, the
running maximum of their ends is taken, and a group breaks where a token's
start reaches that maximum. Within a group every A token is linked with every
B token.

Neither tokenizer joins a word with the space after it, so a text's groups are
those of its words in order: the distinct words of a block of documents are
tokenized and coalesced once.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import query, stage, table

#: Text bytes of the documents whose distinct words and links are one block.
BLOCK_BYTES = 8 << 20
#: Bytes of words given to a tokenizer as one text, and of text split at once.
PART_BYTES = 1 << 18
#: Bytes of distinct words aligned at once.
WORD_BYTES = 2 << 20
#: Links expanded at once.
LINKS_AT_ONCE = 1 << 21


# ----------------------------------------------------------------- tokenizers

class _Vocabulary:
    """The bytes of every token id, gathered for many ids at once."""

    def __init__(self, tokens: list[bytes]):
        self.size = len(tokens)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self._flat = np.frombuffer(b"".join(tokens), np.uint8)
        self._first = np.concatenate([[0], np.cumsum(self.length)])[:-1]

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self._flat[_ranges(self._first[ids], self.length[ids])]


def _byte_characters() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable
    Latin-1 ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE of the tokenizers library, over space + text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._t = Tokenizer.from_file(path)
        self._t.encode_special_tokens = True
        spec = json.loads(self._t.to_str())
        pre, byte = spec.get("pre_tokenizer") or {}, _byte_characters()
        # The byte-level pattern never puts a character and the space after
        # it into one word.
        self.splits = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") is True
        vocab = self._t.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            tokens[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.vocabulary = _Vocabulary(tokens)

    def encode(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._t.encode_batch_fast(parts, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model that puts a space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self._t = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._t.id_to_piece(i) for i in range(self._t.get_piece_size())]
        # No piece holds a space after another character, so none joins words.
        self.splits = not any("▁" in n.lstrip("▁") for n in names)
        self.vocabulary = _Vocabulary([bytes([int(n[3:5], 16)]) if self._t.is_byte(i) else n.replace("▁", " ").encode()
                                       for i, n in enumerate(names)])

    def encode(self, parts: list[str]) -> list[list[int]]:
        return self._t.encode([p[1:] for p in parts], num_threads=1)


@lru_cache(maxsize=2)
def _tokenizers(path_a: str, path_b: str) -> tuple[ByteBpe, Pieces]:
    return ByteBpe(path_a), Pieces(path_b)


# U+2581 is a space to a sentencepiece model.
_CUT = re.compile(r"(?<=[^\s\u2581]) (?=[^\s\u2581])")
_PLAIN = re.compile(r"[^\s\u2581]+(?:[^\u2581]*[^\s\u2581])?").fullmatch


def words_of(text: str) -> Iterator[list[str]]:
    """The words of a text, part by part: it is their join by single spaces,
    and a tokenizer that ``splits`` sees each with the space before it."""
    lo = 0
    while True:
        m = _CUT.search(text, lo + PART_BYTES) if len(text) - lo > PART_BYTES else None
        yield _CUT.split(text[lo:m.start() if m else len(text)])
        if not m:
            return
        lo = m.end()


def _encode(tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, ids per word) of space + word. Words are tokenized together,
    and told apart by the bytes of their tokens."""
    n, length = len(words), tokenizer.vocabulary.length
    alone = [i for i, w in enumerate(words) if not (tokenizer.splits and _PLAIN(w))]
    other = np.delete(np.arange(n), alone)
    size = np.array([len(words[i].encode()) + 1 for i in other.tolist()], np.int64)
    runs = np.split(other, np.flatnonzero(np.diff(np.cumsum(size) // PART_BYTES)) + 1) if len(other) else []
    got_ids, got_words, got_counts, at = [], [], [], 0
    for run, ids in zip(runs, tokenizer.encode([" " + " ".join(words[i] for i in run.tolist()) for run in runs])):
        ids = np.array(ids, np.int64)
        ends, want = np.cumsum(length[ids]), np.cumsum(size[at:at + len(run)])
        at += len(run)
        stop = np.searchsorted(ends, want)
        if stop[-1] + 1 == len(ends) and np.array_equal(ends[stop], want):
            got_ids.append(ids)
            got_words.append(run)
            got_counts.append(np.diff(stop, prepend=-1))
        else:  # what the tokens spell is not the text: word by word
            alone.extend(run.tolist())
    each = tokenizer.encode([" " + words[i] for i in alone])
    got_ids += [np.array(x, np.int64) for x in each]
    where = np.concatenate([*got_words, np.array(alone, np.int64)])
    counts = np.concatenate([*got_counts, np.array([len(x) for x in each], np.int64)]).astype(np.int64)
    flat = np.concatenate(got_ids) if got_ids else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    order = np.argsort(where)
    return flat[_ranges(first[order], counts[order])], counts[order]


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first[i] .. first[i] + size[i] - 1, one range after another."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - ends + size, size)


# ------------------------------------------------------------------- alignment

@dataclass
class Aligned:
    """Tokens of some words. ``n_a``, ``n_b``: tokens per word. ``a``, ``b``:
    ids in order. ``group_a``, ``group_b``: group of every token, rising over
    all words; no group spans two of them."""
    n_a: np.ndarray
    n_b: np.ndarray
    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray


def coalesce(size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of the A and the B tokens, which cover the same bytes."""
    end = np.concatenate([np.cumsum(size_a), np.cumsum(size_b)])
    start = end - np.concatenate([size_a, size_b])
    order = np.lexsort((end, start))
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    reach = np.maximum.accumulate(end[order])
    group = np.empty(len(order), np.int64)
    group[order] = np.concatenate([[0], np.cumsum(start[order][1:] >= reach[:-1])])
    return group[:len(size_a)], group[len(size_a):]


def align(words: list[str], a: ByteBpe, b: Pieces) -> tuple[Aligned, np.ndarray]:
    """Tokens and groups of the words, each with a space before it, and which
    of them A and B both spell; the others have no tokens."""
    n = len(words)
    want = [(" " + w).encode() for w in words]
    first = np.concatenate([[0], np.cumsum([len(w) for w in want])]).astype(np.int64)
    flat = np.frombuffer(b"".join(want), np.uint8)
    sides, ok = [], np.ones(n, bool)
    for t in (a, b):
        ids, counts = _encode(t, words)
        spelt = t.vocabulary.spell(ids)
        if not np.array_equal(spelt, flat):
            size = W.run_sum(t.vocabulary.length[ids], np.concatenate([[0], np.cumsum(counts)]))
            at = np.concatenate([[0], np.cumsum(size)])
            for i in range(n):
                ok[i] &= np.array_equal(spelt[at[i]:at[i + 1]], flat[first[i]:first[i + 1]])
        sides.append((ids, counts))
    if not ok.all():
        sides = [(ids[np.repeat(ok, counts)], np.where(ok, counts, 0)) for ids, counts in sides]
    (ids_a, n_a), (ids_b, n_b) = sides
    return Aligned(n_a, n_b, ids_a, ids_b, *coalesce(a.vocabulary.length[ids_a], b.vocabulary.length[ids_b])), ok


def _written(got: Aligned, labels: np.ndarray, width: int) -> list[str]:
    """Per word its groups, ``a1,a2|b1;a3|b2,b3``. ``labels``: see _labels."""
    order = np.argsort(np.concatenate([got.group_a * 2, got.group_b * 2 + 1]), kind="stable")
    last_a = np.append(got.group_a[1:] != got.group_a[:-1], True) if len(got.a) else np.zeros(0, bool)
    last_b = np.append(got.group_b[1:] != got.group_b[:-1], True) if len(got.b) else np.zeros(0, bool)
    code = np.concatenate([got.a + width * last_a, got.b + width * (2 + last_b)])[order]
    words = labels[code].tolist()
    at = np.concatenate([[0], np.cumsum(got.n_a + got.n_b)]).tolist()
    return ["".join(words[lo:hi])[:-1] for lo, hi in zip(at[:-1], at[1:])]


@lru_cache(maxsize=1)
def _labels(width: int) -> np.ndarray:
    """An id's text with what follows it: an A token within its group, its
    last one, a B token within its group, its last one."""
    return np.array([f"{i}{mark}" for mark in ",|,;" for i in range(width)], object)


def links(got: Aligned, n_b_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links per word, word, id pair, times) of the distinct linked id pairs
    of every word, in order; a pair is ``a * n_b_ids + b``."""
    n, groups = len(got.n_a), int(got.group_a[-1]) + 1 if len(got.a) else 0
    per_b = np.bincount(got.group_b, minlength=groups)
    first_b = np.concatenate([[0], np.cumsum(per_b)])
    word = np.repeat(np.arange(n), got.n_a)
    fan = per_b[got.group_a] if len(got.a) else np.zeros(0, np.int64)
    n_links = np.bincount(word, fan, n).astype(np.int64)
    where, pairs, times = [], [], []
    # Tokens whose group alone is large enough meet the distinct ids of it.
    large = fan > LINKS_AT_ONCE // 64
    for g in np.unique(got.group_a[large]).tolist():
        mine = np.flatnonzero(got.group_a == g)
        ia, ca = np.unique(got.a[mine], return_counts=True)
        ib, cb = np.unique(got.b[first_b[g]:first_b[g + 1]], return_counts=True)
        for x, c in zip(ia.tolist(), ca.tolist()):
            where.append(np.full(len(ib), word[mine[0]]))
            pairs.append(x * n_b_ids + ib)
            times.append(c * cb)
    small = np.flatnonzero(~large)
    total = np.concatenate([[0], np.cumsum(fan[small])])
    lo = 0
    while lo < len(small):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + LINKS_AT_ONCE, "right")) - 1)
        t, f = small[lo:hi], fan[small[lo:hi]]
        where.append(np.repeat(word[t], f))
        pairs.append(np.repeat(got.a[t], f) * n_b_ids + got.b[_ranges(first_b[got.group_a[t]], f)])
        times.append(np.ones(len(pairs[-1]), np.int64))
        lo = hi
        if sum(map(len, pairs)) > 2 * LINKS_AT_ONCE:
            where, pairs, times = ([x] for x in _distinct(where, pairs, times))
    return n_links, *_distinct(where, pairs, times)


def _distinct(where: list, pairs: list, times: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not pairs:
        return (np.zeros(0, np.int64),) * 3
    w, p, t = np.concatenate(where), np.concatenate(pairs), np.concatenate(times)
    order = np.lexsort((p, w))
    w, p, t = w[order], p[order], t[order]
    new = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (p[1:] != p[:-1]))) if len(p) else np.zeros(0, np.int64)
    return w[new], p[new], np.add.reduceat(t, new) if len(new) else t


# ----------------------------------------------------------------- over a table

#: A document's row: ``at`` counts into its block's ``pairs``. A block has one
#: row more, with the pairs alone and the documents that hold each.
_ROWS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
         "at array<int>, times array<long>, pairs array<long>, docs array<int>")


_SCHEMA = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                     ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("at", pa.list_(pa.int32())),
                     ("times", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32()))])


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values, kind))


class _Block:
    """Documents as sequences of numbered distinct words."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: list[str | None], splits: bool) -> None:
        number = self.number
        for text in texts:
            parts = (words_of(text) if splits else [[text]]) if text else []
            coded = [np.array([number.setdefault(w, len(number)) for w in words], np.int32) for words in parts]
            self.texts.append(np.concatenate([*coded, np.zeros(0, np.int32)]))
        self.ids.append(ids)

    def rows(self, block: int, a: ByteBpe, b: Pieces) -> Iterator[pa.RecordBatch]:
        """The documents' rows, then the block's own."""
        n_words, ok, written, sums, word_first, word_pairs, word_times = self._words(a, b)
        codes = [c if ok[c].all() else c[:0] for c in self.texts]
        n = len(codes)
        text = np.repeat(np.arange(n), [len(c) for c in codes])
        each, count = np.unique(text * max(n_words, 1) + np.concatenate([*codes, np.zeros(0, np.int32)]), return_counts=True)
        text, word = each // max(n_words, 1), each % max(n_words, 1)
        first = np.searchsorted(text, np.arange(n + 1))
        per_text = [W.run_sum(s[word] * count, first) for s in sums]
        fan = np.diff(word_first)[word]
        at = _ranges(word_first[:-1][word], fan)
        where, pairs, times = _distinct([np.repeat(text, fan)], [word_pairs[at]], [word_times[at] * np.repeat(count, fan)])
        every, inverse, docs = np.unique(pairs, return_inverse=True, return_counts=True)
        begins = np.searchsorted(where, np.arange(n + 1))
        ids = pa.concat_arrays(self.ids)
        lo = 0
        while lo < n:  # rows of some words at a time: the written groups are long
            hi, size = lo + 1, len(codes[lo])
            while hi < n and size + len(codes[hi]) <= WORD_BYTES // 8:
                size += len(codes[hi])
                hi += 1
            mine, per_doc = slice(int(begins[lo]), int(begins[hi])), np.diff(begins[lo:hi + 1])
            texts = [";".join(map(written.__getitem__, c.tolist())) for c in codes[lo:hi]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(hi - lo, block)), ids.slice(lo, hi - lo), *[pa.array(s[lo:hi]) for s in per_text],
                 pa.array(texts, pa.string()), _lists(inverse[mine], per_doc, pa.int32()), _lists(times[mine], per_doc, pa.int64()),
                 pa.nulls(hi - lo, pa.list_(pa.int64())), pa.nulls(hi - lo, pa.list_(pa.int32()))], schema=_SCHEMA)
            lo = hi
        own = {"block": [block], "pairs": [every], "docs": [docs]}
        yield pa.RecordBatch.from_arrays([pa.array(own.get(f.name, [None]), f.type) for f in _SCHEMA], schema=_SCHEMA)

    def _words(self, a: ByteBpe, b: Pieces):
        """(number of words, spelt, written groups, (tokens of A, of B, groups,
        links), first link, id pairs, times) of the distinct words."""
        words = list(self.number)
        width = max(a.vocabulary.size, b.vocabulary.size)
        ok, written, sums, first, pairs, times = [], [], [[], [], [], []], [], [], []
        lo, known = 0, 0
        while lo < len(words):
            hi, size = lo, 0
            while hi < len(words) and (hi == lo or size < WORD_BYTES):
                size += len(words[hi])
                hi += 1
            got, spelt = align(words[lo:hi], a, b)
            n = hi - lo
            n_links, where, p, t = links(got, b.vocabulary.size)
            new = np.append(True, got.group_a[1:] != got.group_a[:-1]) if len(got.a) else np.zeros(0, bool)
            n_groups = np.bincount(np.repeat(np.arange(n), got.n_a)[new], minlength=n).astype(np.int64)
            for held, x in zip(sums, (got.n_a, got.n_b, n_groups, n_links)):
                held.append(x)
            ok.append(spelt)
            written += _written(got, _labels(width), width)
            first.append(known + np.searchsorted(where, np.arange(n)))
            pairs.append(p)
            times.append(t)
            known += len(p)
            lo = hi
        none = np.zeros(0, np.int64)
        return (len(words), np.concatenate([*ok, np.zeros(0, bool)]), written, [np.concatenate([*s, none]) for s in sums],
                np.concatenate([*first, [known]]).astype(np.int64), np.concatenate([*pairs, none]), np.concatenate([*times, none]))


def _aligned_rows(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    a, b = _tokenizers(path_a, path_b)
    task = TaskContext.get().partitionId() << 32
    block, held = 0, _Block()
    for rows, buf, _ in W.slices(batches, "text"):
        held.add(rows.column("doc_id"), rows.column("text").to_pylist(), a.splits and b.splits)
        held.size += len(buf)
        if held.size >= BLOCK_BYTES:
            yield from held.rows(task + block, a, b)
            block, held = block + 1, _Block()
            pa.default_memory_pool().release_unused()
    if held.texts:
        yield from held.rows(task + block, a, b)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), with its tokens and links,
    and one per block of documents (``pairs`` not null, all else null).

    ``path_a``: a byte-level BPE of the tokenizers library, given space + text.
    ``path_b``: a sentencepiece model that adds the space itself. Special
    tokens' strings are plain text. Byte offsets where an A and a B token both
    end cut the tokens into groups; a link is a pair of an A and a B token of
    one group. ``groups`` writes the ids of all groups, ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts that the tokens of A or B do not spell,
    have no tokens. A null doc_id is kept, repeated rows are documents each,
    further columns are ignored, an empty table gives no rows. A text without a
    space is one word; a block holds the distinct words of its documents.
    """
    return docs.select("doc_id", "text").mapInArrow(partial(_aligned_rows, path_a=path_a, path_b=path_b), _ROWS)


def pair_counts(rows: DataFrame, n_b_ids: int) -> DataFrame:
    """(pair, n_docs, best) of staged ``rows``: in how many documents an id
    pair is linked, and whether no pair of its A id is linked in more."""
    counts = stage(rows.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
                   .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("n_docs")), "pair-counts")
    # One row per id of A at most.
    top = counts.groupBy(F.expr(f"pair div {n_b_ids}").alias("a")).agg(F.max("n_docs").alias("top"))
    return counts.join(F.broadcast(top), F.expr(f"pair div {n_b_ids}") == F.col("a")) \
        .select("pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))


def _count_block(docs: pa.Table, counts: pa.Table, keep: tuple[str, ...]) -> pa.Table:
    """Sums over the links of each document of a block."""
    order = np.argsort(np.asarray(counts["pair"]))
    n_docs, best = np.asarray(counts["n_docs"])[order], np.asarray(counts["best"]).astype(np.int64)[order]
    docs = docs.combine_chunks()
    n = docs.num_rows
    sums = np.zeros((2, n), np.int64)
    lists = docs["at"].combine_chunks() if n else None
    if n and len(lists.values):
        lengths = np.diff(np.asarray(lists.offsets))
        at = np.asarray(lists.flatten())
        times = np.asarray(docs["times"].combine_chunks().flatten())
        first = np.concatenate([[0], np.cumsum(lengths)])
        sums[0], sums[1] = W.run_sum(best[at] * times, first), W.run_sum(n_docs[at] * times, first)
    out = docs.select(list(keep))
    return out.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))


def with_counts(rows: DataFrame, n_b_ids: int, keep: tuple[str, ...]) -> DataFrame:
    """The documents of staged ``rows`` (columns ``keep``) with n_best (links
    whose count is the highest of their A id) and count_sum (counts of all
    links). What is shuffled are the distinct pairs of a block of documents,
    not those of each document; a block comes together in one task."""
    counts = pair_counts(rows, n_b_ids)
    asked = rows.where("pairs is not null").select(F.col("block").alias("of"), F.explode("pairs").alias("pair"))
    known = asked.join(counts, "pair").select("of", "pair", "n_docs", "best")
    docs = rows.where("pairs is null").select("block", *keep, "at", "times")
    schema = ", ".join([f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep] + ["n_best long", "count_sum long"])
    return docs.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        partial(_count_block, keep=keep), schema)


def _named(*names: str) -> tuple[str, ...]:
    import public_tokenizers
    return tuple(public_tokenizers.path(n) for n in names)


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = _named("byte_bpe_50k.json", "piece_bpe_32k.model")
    n_b_ids = _tokenizers(path_a, path_b)[1].vocabulary.size
    rows = aligned(table(spark, sf_dir, "documents"), path_a, path_b)
    # The written groups are long: their digest is taken before the rows are kept.
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    rows = stage(rows.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return with_counts(rows, n_b_ids, ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"))
