"""Hierarchical language identification.

Byte n-gram frequencies of the whole text go first to a one-versus-rest linear
SVM over language families, then to one-versus-one linear SVMs between the
languages of the family chosen.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import query, table
from strata.llm.quality import fold_of

#: Family of a language code; others form the family of their own code.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic", "sr": "slavic",
}
#: Hashed n-gram features (n = 1, 2, 3) and the documents a language is
#: learned from, at most.
BUCKETS, SAMPLE_PER_LANG = 4096, 800
#: Sampled texts of all languages together (their features lie on the driver).
MAX_SAMPLE = 20_000
_NGRAMS = (1, 2, 3)

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
#: Bytes that are no letters count as one separator.
_LOW[[b for b in range(128) if not (97 <= b <= 122 or 65 <= b <= 90)]] = 32


def ngram_slots(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature of every n-gram, first n-gram of each text). N-grams do not
    cross texts; runs of separators count once."""
    low = _LOW[buf]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 32) | (low[:-1] != 32) | edge[1:len(low)]
    first = np.concatenate([[0], np.cumsum(keep)])[offsets]
    low = low[keep].astype(np.uint32)
    n = len(low)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    slots = np.full((n, len(_NGRAMS)), -1, np.int32)
    code = np.zeros(n, np.uint32)
    for j, size in enumerate(_NGRAMS):
        m = n - size + 1
        if m <= 0:
            break
        code = code[:m] * np.uint32(256) + low[size - 1:]
        h = (code + np.uint32(size << 28)) * np.uint32(2654435761)
        h ^= h >> np.uint32(15)
        h *= np.uint32(2246822519)
        inside = owner[:m] == owner[size - 1:]
        slots[:m, j][inside] = (h >> np.uint32(20)).astype(np.int32)[inside]
    return slots, first


def features(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, BUCKETS) square-rooted n-gram frequencies (dense: samples only)."""
    slots, first = ngram_slots(buf, offsets)
    out = np.zeros((len(offsets) - 1, BUCKETS))
    for i in range(len(out)):
        own = slots[first[i]:first[i + 1]].reshape(-1)
        out[i] = np.bincount(own[own >= 0], minlength=BUCKETS)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def fit_svm(x: np.ndarray, y: np.ndarray, rounds: int = 300, reg: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge, Nesterov steps; classes weighed alike)."""
    weight = np.where(y > 0, .5 / max((y > 0).sum(), 1), .5 / max((y < 0).sum(), 1)).astype(x.dtype)
    y = y.astype(x.dtype)
    w, b = np.zeros(x.shape[1], x.dtype), 0.0
    vw, vb = w.copy(), 0.0
    step = 1 / (2 * (1 + float(np.einsum("ij,ij->i", x, x).max())) + reg)
    for t in range(rounds):
        margin = np.maximum(0, 1 - y * (x @ vw + vb))
        pull = 2 * weight * y * margin
        nw, nb = vw + step * (x.T @ pull - reg * vw), vb + step * pull.sum()
        look = t / (t + 3)
        vw, vb, w, b = nw + look * (nw - w), nb + look * (nb - b), nw, nb
    return w, b


class Model:
    """Scorers as columns of one weight matrix: families first, then pairs."""

    def __init__(self, langs: list[str], x: np.ndarray, lang: np.ndarray):
        self.langs = langs
        self.families: dict[str, list[int]] = {}
        for i, code in enumerate(langs):
            self.families.setdefault(FAMILIES.get(code, code), []).append(i)
        self.family_names = sorted(self.families)
        # Frequencies are scaled so that common and rare features weigh alike.
        # Single precision halves what the driver holds of the sample.
        z = x.astype(np.float32)
        self.center = z.mean(axis=0) if len(x) else np.zeros(BUCKETS, np.float32)
        self.scale = (1 / (z.std(axis=0) + 1e-3) / np.sqrt(BUCKETS) if len(x) else np.ones(BUCKETS)).astype(np.float32)
        z -= self.center
        z *= self.scale
        columns, self.pairs = [], []
        for name in self.family_names if len(self.family_names) > 1 else []:
            columns.append(fit_svm(z, np.where(np.isin(lang, self.families[name]), 1, -1)))
        self.n_family = len(columns)
        for name in self.family_names:
            own = self.families[name]
            for a in range(len(own)):
                for b in range(a + 1, len(own)):
                    rows = np.isin(lang, [own[a], own[b]])
                    columns.append(fit_svm(z[rows], np.where(lang[rows] == own[a], 1, -1)))
                    self.pairs.append((name, own[a], own[b]))
        w = np.stack([c[0] for c in columns], axis=1) if columns else np.zeros((BUCKETS, 0))
        self.weights = (w * self.scale[:, None]).astype(np.float32)
        self.bias = np.array([c[1] for c in columns]) - (self.center * self.scale) @ w

    def predict(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language index, score 0 to 1) of every text."""
        slots, first = ngram_slots(buf, offsets)
        n = len(offsets) - 1
        used = slots >= 0
        count = np.zeros(n, np.int64)
        margins = np.zeros((n, self.weights.shape[1]))
        for j in range(slots.shape[1]):
            count += W.run_sum(used[:, j].astype(np.int64), first)
            at = np.where(used[:, j], slots[:, j], 0)
            for c in range(self.weights.shape[1]):
                margins[:, c] += W.run_sum(np.where(used[:, j], self.weights[:, c][at], 0).astype(np.float64), first)
        margins = margins / np.maximum(count, 1)[:, None] + self.bias
        sure = 1 / (1 + np.exp(-2 * np.clip(margins, -20, 20)))
        best = np.zeros(n, np.int64)
        score = np.ones(n)
        if self.n_family:
            best = margins[:, :self.n_family].argmax(axis=1)
            score = sure[np.arange(n), best]
        lang = np.zeros(n, np.int64)
        for f, name in enumerate(self.family_names):
            own, rows = self.families[name], np.flatnonzero(best == f)
            votes, trust = np.zeros((len(rows), len(self.langs))), np.zeros((len(rows), len(self.langs)))
            for c, (of, a, b) in enumerate(self.pairs, self.n_family):
                if of == name:
                    p = sure[rows, c]
                    votes[np.arange(len(rows)), np.where(p >= .5, a, b)] += 1
                    trust[:, a] += p
                    trust[:, b] += 1 - p
            pick = np.array(own)[(votes + 1e-3 * trust)[:, own].argmax(axis=1)] if len(rows) else rows
            lang[rows] = pick
            if len(own) > 1 and len(rows):
                score[rows] *= trust[np.arange(len(rows)), pick] / (len(own) - 1)
        return lang, score


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, offsets in W.slices(batches, "text"):
        x = features(buf, offsets).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [rows.column("lang"), pa.ListArray.from_arrays(
                pa.array((np.arange(len(x) + 1) * BUCKETS).astype(np.int32)), pa.array(x.reshape(-1)))], names=["lang", "x"])


def train(docs: DataFrame, folds: int = 3, held_out: int = 1) -> Model | None:
    """Learn from text and non-null lang of documents whose fold is not
    ``held_out``; of each language the different texts with the smallest
    hashes, at most SAMPLE_PER_LANG of them and, of many languages, an equal
    share of MAX_SAMPLE. However often a text is repeated, it counts once.
    None if there is nothing to learn from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold_of("doc_id", folds) != held_out))
    mark = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct(mark, 0.02).alias("n")).collect()  # one row a language
    if not sizes:
        return None
    per = min(SAMPLE_PER_LANG, max(1, MAX_SAMPLE // len(sizes)))
    share = F.lit(1.0)
    for r in sizes:  # the share of a language's hashes that gives about the sample
        if r.n > 1.3 * per:
            share = F.when(F.col("lang") == r.lang, F.lit(1.3 * per / r.n)).otherwise(share)
    part = mark / float(1 << 40)
    picked = known.select("lang", "text", part.alias("m"), share.alias("s")).where("m < s").select("lang", "m", "text").distinct()
    order = Window.partitionBy("lang").orderBy("m", "text")
    sample = picked.withColumn("at", F.row_number().over(order)).where(F.col("at") <= per).orderBy("lang", "at").select("lang", "text")
    got = sample.mapInArrow(_feature_rows, "lang string, x array<float>").toArrow()
    langs = sorted(r.lang for r in sizes)
    at = {code: i for i, code in enumerate(langs)}
    lang = np.array([at[v] for v in got.column("lang").to_pylist()])
    x = np.concatenate([np.asarray(c.values) for c in got.column("x").chunks]).reshape(-1, BUCKETS)
    return Model(langs, x, lang)


def _predict_rows(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for rows, buf, offsets in W.slices(batches, "text"):
        n = rows.num_rows
        lettered = np.asarray(rows.column("lettered"))
        if model is None:
            lang, score = np.array(["und"] * n, object), np.zeros(n)
        else:
            code, score = model.predict(buf, offsets)
            lang = np.where(lettered, np.array(model.langs, object)[code], "und")
            score = np.where(lettered, score, 0.0)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1))],
                                         names=["doc_id", "lang_pred", "score"])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` from its whole text
    alone. ``und`` with score 0 where the text is null or has no letter, and
    everywhere if there was nothing to learn from. Repeated rows are returned
    each; further columns are ignored."""
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", "text", lettered.alias("lettered")) \
        .mapInArrow(partial(_predict_rows, model=model), "doc_id long, lang_pred string, score double")


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs)).select(
        "doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
