"""Arrow text columns as flat byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, starts, data = column.buffers()
    if not len(column) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(starts, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, rows: int, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``rows`` rows and, beyond one row, ``size`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield i, j
        i = j


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(norm > 0, norm, 1)


def pieces(data: np.ndarray, offsets: np.ndarray, rows: int, size: int, stop: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of about ``size`` bytes; one text that is longer comes in parts, cut at ``stop`` bytes."""
    for i, j in runs(offsets, rows, size):
        a, end = int(offsets[i]), int(offsets[j])
        if j > i + 1 or end - a <= size:
            yield i, data[a:end], offsets[i : j + 1] - a
            continue
        while a < end:
            b = min(a + size, end)
            if b < end and len(cut := np.flatnonzero(stop[data[a:b]])):
                b = a + int(cut[-1]) + 1
            yield i, data[a:b], np.array([0, b - a])
            a = b


_ODD = np.uint64(0x9E3779B97F4A7C15)


class Spans:
    """Hashes of any spans of a byte array, each in constant time (a polynomial modulo 2^64, mixed)."""

    def __init__(self, data: np.ndarray):
        powers = np.cumprod(np.full(len(data) + 1, _ODD, np.uint64))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])))
        self.inverse = np.cumprod(np.full(len(data) + 1, np.uint64(pow(int(_ODD), -1, 1 << 64)), np.uint64))

    def of(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start] + np.uint64(salt * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def word_spans(data: np.ndarray, offsets: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the maximal runs of letter bytes inside each row."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[:-1] = letter[data]
    change = np.diff(inside, prepend=np.int8(0))
    begins = change == 1
    first = offsets[:-1][np.diff(offsets) > 0]
    joined = first[(inside[first] == 1) & (change[first] == 0)]  # a word that would run over from the row before
    begins[joined] = True
    start = np.flatnonzero(begins)
    stop = change == -1
    stop[joined] = True
    return np.searchsorted(offsets, start, side="right") - 1, start, np.flatnonzero(stop)
