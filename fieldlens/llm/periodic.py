"""Runs of periodic words by recursive frequency splitting and lag scans.

A run is a stretch of consecutive words with a smallest period q (words q apart are equal) that holds the period at
least ``times`` times, has at least ``least`` words and cannot be made longer at either end. Every word of a run is in it
``times`` times or more, so a word that is rarer inside a segment belongs to no run there and splits it. Splitting goes on,
with counts taken anew inside each part, until nothing changes; what is left is usually very little.

A surviving segment is scanned lag by lag: words are compared with the words q places later, and long enough stretches of
equality are runs. Only lags at which some block of words comes again for the first time can be smallest periods, so only
those are scanned; blocks of 8, 16, 32, ... words are named by doubling, which compares words and not hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.columnar import runs as slices

LEAST, TIMES = 24, 3
_SLICE = 4 << 20
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _as_bytes(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def segments(word: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches, inside the documents that ``offsets`` bound, that frequency splitting leaves."""
    at = np.arange(len(word))
    part = np.searchsorted(offsets, at, "right") - 1
    width = int(word.max()) + 1 if len(word) else 1
    while len(at):
        _, which, seen = np.unique(part * np.int64(width) + word[at], return_inverse=True, return_counts=True)
        keep = seen[which] >= times
        at, part = at[keep], part[keep]
        if not len(at):
            return
        new = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(part, prepend=-1) != 0))
        size = np.diff(np.append(new, len(at)))
        long = size >= least
        part = np.repeat(np.arange(len(new)), size)
        if keep.all() and long.all():
            yield from zip(at[new].tolist(), (at[new] + size).tolist())
            return
        at, part = at[long[part]], part[long[part]]


def lags(word: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[int]:
    """All distances that can be the smallest period of a run, in ascending order.

    A run of smallest period q, m/2 < q <= m, holds a block of m words at its start and again q places later, and
    nowhere between: so q is the distance from some block of m words to the next equal block.
    """
    size, name, found, low = 1, word, [], 0
    first = 1 << ((least // 2).bit_length() - 1)
    while True:
        if size >= first:
            order = np.argsort(name, kind="stable")
            step = np.diff(order)[name[order][1:] == name[order][:-1]]
            found.append(np.unique(step[(step > low) & (step <= size)]))
            low = size
        if low * times >= len(word) or 2 * size > len(name) + size - 1:
            return [int(q) for q in np.concatenate(found) if q * times <= len(word)] if found else []
        pair = name[:-size] * np.int64(int(name.max()) + 1) + name[size:]
        name = np.unique(pair, return_inverse=True)[1]
        size *= 2


def runs_of(word: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one segment, by start, then period."""
    found: dict[tuple[int, int], int] = {}
    for q in lags(word, least, times):
        same = np.zeros(len(word) - q + 2, np.int8)
        same[1:-1] = word[:-q] == word[q:]
        edge = np.diff(same)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        for a, b in zip(start, end):
            if b - a + q >= max(least, times * q):
                found.setdefault((int(a), int(b - a + q)), q)  # a multiple of the period finds the same stretch again
    return sorted((a, n, q) for (a, n), q in found.items())


def _scan(least: int, times: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = _as_bytes(batch.column(1))
            sizes = np.array([0 if t is None else len(t) for t in (x.as_buffer() for x in column)], np.int64) if len(column) else np.empty(0, np.int64)
            for i, j in slices(np.concatenate(([0], np.cumsum(sizes))), 1 << 20, _SLICE):
                texts = [(t.as_py() or b"").split() for t in column.slice(i, j - i)]
                offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
                flat = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
                word = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                own: dict[int, list] = {}
                for a, b in segments(word, offsets, least, times):
                    if some := runs_of(word[a:b], least, times):
                        row = int(np.searchsorted(offsets, a, "right")) - 1
                        own.setdefault(row, []).extend((a - int(offsets[row]) + s, n, q) for s, n, q in some)
                collapsed = []
                for row, words in enumerate(texts):
                    if row in own:
                        keep = np.ones(len(words), bool)
                        for s, n, q in own[row]:
                            keep[s + q : s + n] = False
                        words = [w for w, k in zip(words, keep) if k]
                    collapsed.append(b" ".join(words))
                per_row = [sorted(own.get(row, ())) for row in range(len(texts))]
                listed = np.array([r for rows in per_row for r in rows], np.int64).reshape(-1, 3)
                struct = pa.StructArray.from_arrays([pa.array(listed[:, k]) for k in range(3)], ["start", "length", "period"])
                bounds = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in per_row]))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(bounds, struct), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["key", "n_words", "runs", "collapsed"],
                )

    return each


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row of ``docs``: key, n_words, runs (array of start, length, period, by start, then period) and collapsed text.

    Words are what blanks (space, tab to carriage return) separate, numbered from 0; null and empty texts have none.
    ``collapsed`` joins by one space the words that no run holds after its first period. A document is scanned whole,
    whatever its length. Repeated rows are scanned each, other columns of ``docs`` do not matter, null keys stay null,
    an empty table gives an empty result. ``times`` is 3 or more, ``least`` 4 or more. Nothing is shuffled.
    """
    if times < 3 or least < 4:
        raise ValueError("a run repeats its period three times or more and has four words or more")
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    out = rows.mapInArrow(_scan(least, times), f"key {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
    return out.withColumnRenamed("key", key) if key not in out.columns[1:] else out


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly; the first of equal ones."""
    more = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, r: F.when(best.isNull() | more(best, r), r).otherwise(best))


def run_digest(runs: Column) -> Column:
    """SHA-256 of a line ``start,length,period`` for each run."""
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return F.sha2(F.array_join(line, "").cast("binary"), 256)
