"""Vectorised views of a column of texts: its UTF-8 bytes, words, and hashes of any stretch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import mix64

#: ASCII white space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Lower case of A-Z; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# The base of the polynomial hash, and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_SPREAD = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_powers: dict[str, np.ndarray] = {}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins (one more offset than texts)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _power(base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(str(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 1 << 21:
            _powers[str(base)] = known
    return known[:n]


class Hashes:
    """64-bit hashes of stretches of a byte array; equal stretches have equal hashes."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_SPREAD[data] * _power(BASE, len(data)), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * _power(INVERSE, len(self.sums))[start] + (end - start).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all stretches of ``size`` bytes."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix64((self.sums[size:] - self.sums[:n]) * _power(INVERSE, n))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (no white space, within one text), and the number of words before each text."""
    inside = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~first[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~first[1:]
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)
