"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from features of itself and its two
neighbours; the chain's forward-backward marginals, weighted by line length,
give the document's score. Lines of the labelled documents carry their
document's label in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import query, table

#: Labelled documents the model is fitted on, at most, of each class; longer
#: ones enter training as runs of TRAIN_LINES lines (scoring never cuts).
SAMPLE_PER_CLASS, TRAIN_LINES = 2000, 128
#: A document scoring at least this is predicted good.
THRESHOLD = 0.3


def _byte_class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars.encode("latin-1"), np.uint8)] = True
    return out


_UPPER = _byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _byte_class("abcdefghijklmnopqrstuvwxyz")
_LETTER[0xC0:] = True  # the first byte of a non-ASCII character
_CLASSES = [_LETTER, _UPPER, _byte_class("0123456789"), _byte_class("|"), _byte_class("!"),
            _byte_class("#$%&*@^~_=<>{}[]\\+/`"), _byte_class(".,;:?")]
N_OWN = 13


def line_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first line of each text) of the lines of a slice; a text
    has one line more than line feeds, so an empty one has one empty line."""
    feeds = np.flatnonzero(buf == 10)
    per = np.diff(np.searchsorted(feeds, offsets)) + 1
    first = np.concatenate([[0], np.cumsum(per)])
    start = np.empty(first[-1], np.int64)
    opens = np.zeros(first[-1], bool)
    opens[first[:-1]] = True
    start[opens], start[~opens] = offsets[:-1], feeds + 1
    end = np.empty_like(start)
    closes = np.zeros(first[-1], bool)
    closes[first[1:] - 1] = True
    end[closes], end[~closes] = offsets[1:], feeds
    return start, end, first


def line_features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own features of each line, line lengths, first line of each text)."""
    start, end, first = line_bounds(buf, offsets)
    size = (end - start).astype(float)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(buf) + 1, np.int32)
        np.cumsum(mask, out=total[1:])
        return (total[end] - total[start]).astype(float)

    letters, upper, digits, bars, bangs, symbols, stops = (count(c[buf]) for c in _CLASSES)
    w = W.Words(buf, offsets, W.SPACED)
    line_of = np.searchsorted(start, w.start, "right") - 1
    n_lines = len(start)
    n_words = np.bincount(line_of, minlength=n_lines).astype(float)
    again = np.zeros(len(line_of), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (line_of[1:] == line_of[:-1])
    repeats = np.bincount(line_of[again], minlength=n_lines).astype(float)
    titled = np.bincount(line_of[_UPPER[buf[w.start]]], minlength=n_lines).astype(float)
    some, per_word = np.maximum(size, 1), np.maximum(n_words, 1)
    last = np.where(size > 0, buf[np.maximum(end - 1, 0)] if len(buf) else 0, 0)
    x = np.stack([np.ones(n_lines), upper / np.maximum(letters, 1), 2 * np.minimum(digits / some, .5), np.minimum(4 * bars / per_word, 1),
                  np.minimum(4 * bangs / per_word, 1), np.minimum(4 * symbols / some, 1), np.minimum(stops / per_word, 1),
                  np.minimum(4 * repeats / per_word, 1), np.log1p(size) / 8, np.minimum(size / per_word / 20, 1), titled / per_word,
                  np.isin(last, [33, 46, 63]).astype(float), (size == 0).astype(float)], axis=1)
    return x, size, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and of the line after (zeros
    beyond a text's ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate([x, before, after], axis=1)


def marginals(unary: np.ndarray, trans: np.ndarray, first: np.ndarray, pairs: bool = False, weight=None):
    """P(line is good) under the chain, for all texts of a slice at once, and
    with ``pairs`` the (weighted) expected transition counts.

    The recursion runs over line positions; at each, over all texts that long.
    """
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes_down = first[:-1][order], sizes[order]
    top = int(sizes_down[0]) if len(sizes_down) else 0
    active = np.searchsorted(-sizes_down, -np.arange(top), "left")  # texts longer than t
    fwd, bwd = np.zeros((len(unary), 2)), np.zeros((len(unary), 2))
    for t in range(top):
        at = begin[:active[t]] + t
        if t:
            prev = fwd[at - 1]
            fwd[at, 0] = np.logaddexp(prev[:, 0] + trans[0, 0], prev[:, 1] + trans[1, 0])
            fwd[at, 1] = np.logaddexp(prev[:, 0] + trans[0, 1], prev[:, 1] + trans[1, 1])
        fwd[at, 1] += unary[at]
    for t in range(top - 2, -1, -1):
        at = begin[:active[t + 1]] + t
        nxt0, nxt1 = bwd[at + 1, 0], bwd[at + 1, 1] + unary[at + 1]
        bwd[at, 0] = np.logaddexp(trans[0, 0] + nxt0, trans[0, 1] + nxt1)
        bwd[at, 1] = np.logaddexp(trans[1, 0] + nxt0, trans[1, 1] + nxt1)
    gap = np.clip(fwd[:, 0] + bwd[:, 0] - fwd[:, 1] - bwd[:, 1], -500, 500)
    p = 1 / (1 + np.exp(gap))
    if not pairs:
        return p
    inner = np.ones(len(unary), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    logz = np.logaddexp(fwd[:, 0] + bwd[:, 0], fwd[:, 1] + bwd[:, 1])[at]
    joint = np.zeros((2, 2))
    for i in range(2):
        for j in range(2):
            joint[i, j] = (weight[at] * np.exp(fwd[at - 1, i] + trans[i, j] + j * unary[at] + bwd[at, j] - logz)).sum()
    return p, joint


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 300,
        l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights, transitions) of the chain by Adam on the weighted
    log-likelihood; ``label`` and ``weight`` are given per line."""
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    scale = weight.sum()
    inner = np.ones(len(x), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[at - 1], label[at]), weight[at])
    for step in range(1, rounds + 1):
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        p, joint = marginals(x @ w, trans, first, True, weight)
        grad = np.concatenate([x.T @ (weight * (label - p)), (seen - joint).ravel()]) / scale - l2 * theta
        m, v = .9 * m + .1 * grad, .99 * v + .01 * grad ** 2
        theta += .1 * (m / (1 - .9 ** step)) / (np.sqrt(v / (1 - .99 ** step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offsets in W.slices(batches, "text"):
        x, _, first = line_features(buf, offsets)
        yield pa.RecordBatch.from_arrays(
            [rows.column("quality"), pa.ListArray.from_arrays(pa.array((first * N_OWN).astype(np.int32)),
                                                              pa.array(x.reshape(-1).astype(np.float32)))],
            names=["quality", "x"])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5, held_out: int = 0):
    """Fit on documents whose label is 0 or 1 and whose fold (crc32 of the
    doc_id's text modulo ``folds``) is not ``held_out``.

    At most SAMPLE_PER_CLASS documents a class, those with the smallest
    hashes, weighted back to the class's full number. A doc_id with
    contradicting labels counts as 0. With one class only, or none, every
    score is 0.5."""
    known = labels.where(F.col(label_col).isin(0, 1) & (fold_of("doc_id", folds) != held_out)) \
        .groupBy("doc_id").agg(F.min(label_col).cast("int").alias("quality")).join(docs.select("doc_id").distinct(), "doc_id")
    sizes = {r.quality: r.n for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return np.zeros(3 * N_OWN), np.zeros((2, 2))
    picked = None
    for c in (0, 1):
        part = known.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_CLASS)
        picked = part if picked is None else picked.unionByName(part)
    # Twice SAMPLE_PER_CLASS rows at most: that is the bound of the broadcast.
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id") \
        .mapInArrow(_sample_rows, "quality int, x array<float>").toArrow()
    quality = np.asarray(sample.column("quality").combine_chunks())
    xs, firsts, labels_, weights = [], [0], [], []
    used = {c: max(int((quality == c).sum()), 1) for c in (0, 1)}
    for c, flat in zip(quality.tolist(), sample.column("x")):
        own = np.asarray(flat.values, float).reshape(-1, N_OWN)
        full = with_neighbours(own, np.array([0, len(own)]))
        for lo in range(0, len(full), TRAIN_LINES):
            part = full[lo:lo + TRAIN_LINES]
            xs.append(part)
            firsts.append(firsts[-1] + len(part))
        labels_.append(np.full(len(full), c))
        # A document weighs the same whatever its number of lines.
        weights.append(np.full(len(full), sizes[c] / used[c] / len(full)))
    return fit(np.concatenate(xs), np.array(firsts), np.concatenate(labels_), np.concatenate(weights))


def fold_of(col: str, folds: int):
    return F.crc32(F.col(col).cast("string").cast("binary")) % folds


def _score_rows(batches: Iterator[pa.RecordBatch], w: np.ndarray, trans: np.ndarray) -> Iterator[pa.RecordBatch]:
    for rows, buf, offsets in W.slices(batches, "text"):
        x, size, first = line_features(buf, offsets)
        p = marginals(with_neighbours(x, first) @ w, trans, first)
        heavy = size + 1
        score = np.add.reduceat(p * heavy, first[:-1]) / np.add.reduceat(heavy, first[:-1])
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.clip(score, 0, 1))], names=[*rows.schema.names, "score"])


def score(docs: DataFrame, model) -> DataFrame:
    """``docs`` with a column score (0 to 1, higher: good likelier) from the
    whole text; null and empty texts are one empty line. Columns stay; one
    named score is replaced. No other column is read."""
    docs = docs.drop("score")
    schema = docs.withColumn("score", F.lit(0.0)).schema
    return docs.mapInArrow(partial(_score_rows, w=model[0], trans=model[1]), schema)


@query("op8_crf_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = score(docs.select("doc_id", "text"), train(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
