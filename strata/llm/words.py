"""Vectorised word splitting and hashing over UTF-8 bytes.

Every function takes whole texts of a slice of rows at once. Word classes are
byte tables: all bytes of a multi-byte UTF-8 character are >= 0x80, so a class
that takes or leaves all non-ASCII characters can be decided byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once (a longer single text is one slice).
SLICE_BYTES = 1 << 21


def _table(is_word) -> np.ndarray:
    """byte -> lower-cased byte, or 0 where the byte separates words."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        out[b] = low if is_word(low) else 0
    return out


#: Words ``[^\x20\x09-\x0D]+``. Byte 0 is a word byte there; it is mapped to
#: 0xFF, which no UTF-8 text holds.
SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
SPACED[0] = 0xFF
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a-z and non-ASCII.
ALNUM = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(z: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    z = z ^ (z >> np.uint64(30))
    z *= _C1
    z ^= z >> np.uint64(27)
    z *= _C2
    z ^= z >> np.uint64(31)
    return z


def odd_constants(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLD + np.uint64(seed)) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut record batches into row slices of about ``SLICE_BYTES`` of text:
    (batch slice, bytes, offsets)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        buf, offsets = text_bytes(batch.column(text))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, "right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo), buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            lo = hi


class Words:
    """Words of a slice: ``hash`` (uint64, one per word), ``start``/``end``
    (byte positions) and ``first`` (word index at which each text begins; one
    more entry than texts)."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        n = len(buf)
        low = np.zeros(n + 8, np.uint8)  # room for 8-byte reads at the end
        low[:n] = table[buf]
        is_word = low[:n] != 0
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begins = is_word.copy()
        begins[1:] &= ~is_word[:-1] | edge[1:n]
        ends = is_word.copy()
        ends[:-1] &= ~is_word[1:] | edge[1:n]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self._hash(low)

    def _hash(self, low: np.ndarray) -> np.ndarray:
        lanes = np.ndarray((len(low) - 7,), np.dtype("<u8"), buffer=low, strides=(1,))
        size = self.end - self.start
        h = size.astype(np.uint64) * _GOLD
        at, left, who = self.start.copy(), size.copy(), np.arange(len(size))
        with np.errstate(over="ignore"):
            while len(who):
                v = lanes[at]
                short = left < 8
                v[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
                h[who] = mix((h[who] ^ v) * _C2 + _GOLD)
                more = left > 8
                at, left, who = at[more] + 8, left[more] - 8, who[more]
        return h

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Text index of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def grams(hashes: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of the k words from each position on (len - k + 1 values; those
    that run over a text's end are for the caller to leave out)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    odd = odd_constants(k, seed)
    out = np.full(n, np.uint64(seed), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out += mix(hashes[j:j + n] ^ odd[j]) * odd[j]
        return mix(out)


def run_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each range [first[i], first[i+1])."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[first[1:]] - total[first[:-1]]
