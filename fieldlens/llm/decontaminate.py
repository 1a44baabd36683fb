"""Benchmark decontamination under edit distance.

Item-sized windows of every document meet the benchmark items in three steps:

1. A window within ``RATE * length`` edits of an item keeps many of its 8-byte substrings near their places (each edit
   spoils at most eight). Substring hits are counted by the window start they imply, so starts without enough hits
   are left out; this step loses nothing.
2. Windows and items are embedded by CGK random walks: a pointer walks over the text, staying or moving by random bits
   of step and byte, which turns edit distance into Hamming distance. Bit-sampling LSH, repeated over several walks
   until the target recall is reached, proposes (window, item) pairs.
3. Each pair is verified by the exact edit distance between the item and the best-fitting stretch of the text.

Items are compared in slices of bounded size, each shared with all tasks; texts are never shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.columnar import flat, runs
from fieldlens.llm.common import ROW_HASH, materialise, row_hash, spare

RATE, RECALL, AGREE, SAMPLES, WALKS = 0.1, 0.95, 0.5, 4, 4
STARTS = 8
SHORTEST, LONGEST, GRAM = 40, 8000, 8
SLICE = 8 << 20
_CHUNK, _OVER, _HELD = 4 << 20, 3 * LONGEST, 32 << 20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[list(b"\t\n\x0b\x0c\r")] = 32
_BITS, _MIX = 22, np.uint64(0x9E3779B97F4A7C15)


def reps(recall: float = RECALL) -> int:
    """Repetitions for the recall, where sampled places of a pair at the edit limit agree with probability AGREE."""
    return WALKS * math.ceil(math.log(1 - recall) / math.log(1 - AGREE**SAMPLES) / WALKS)


def normal(text: str) -> bytes:
    """A-Z lower-cased, runs of blanks made one space."""
    return re.sub(rb"[\x20\x09-\x0D]+", b" ", text.encode()).strip(b" ").translate(bytes(_FOLD))


def passages(items: list[tuple[object, str]]) -> list[tuple[object, bytes]]:
    """Items as byte passages; a very long item is cut into several."""
    out = []
    for item, text in items:
        data = normal(text)
        parts = max(1, -(-len(data) // LONGEST))
        size = -(-len(data) // parts) if data else 1
        out += [(item, data[a : a + size]) for a in range(0, len(data), size) if len(data[a : a + size]) >= SHORTEST]
    return out


@lru_cache(1)
def _starts() -> list[int]:
    """Lower bounds of the length classes."""
    at = [SHORTEST]
    while at[-1] <= LONGEST:
        at.append(max(at[-1] + 10, int(at[-1] * 1.08)))
    return at


class Class:
    """Items of nearly one length, their walks and signatures."""

    def __init__(self, number: int, items: list[tuple[object, bytes]]):
        self.items, self.low = items, _starts()[number]
        self.edits = int(RATE * (_starts()[number + 1] - 1))
        self.need = max(1, self.low - GRAM + 1 - GRAM * int(RATE * (self.low + 9)) if self.low < 130 else self.low - GRAM + 1 - GRAM * self.edits)
        rng = np.random.default_rng([42, number])
        self.bits = rng.integers(0, 2, (WALKS, 2 * self.low, 256)).astype(np.uint8)
        self.places = rng.integers(0, 2 * self.low, (WALKS, reps() // WALKS, SAMPLES))
        self.length = np.array([len(d) for _, d in items])
        self.text = np.zeros((len(items), int(self.length.max())), np.uint8)
        for k, (_, d) in enumerate(items):
            self.text[k, : len(d)] = np.frombuffer(d, np.uint8)
        signs = self.signs(self.text[:, : self.low])
        self.order = np.argsort(signs, axis=1, kind="stable")
        self.signed = np.take_along_axis(signs, self.order, axis=1)

    def signs(self, windows: np.ndarray) -> np.ndarray:
        """(repetition, window): the sampled places of the walks."""
        n, width = windows.shape
        ended, rows, out = np.hstack([windows, np.zeros((n, 1), np.uint8)]), np.arange(n), []
        for walk in range(WALKS):
            wanted = np.unique(self.places[walk])
            seen, at, k = np.empty((len(wanted), n), np.uint32), np.zeros(n, np.int64), 0
            for step in range(int(wanted[-1]) + 1):
                sign = ended[rows, at]
                if wanted[k] == step:
                    seen[k] = sign
                    k += 1
                at = np.minimum(at + self.bits[walk, step][sign], width)
            own = np.searchsorted(wanted, self.places[walk])
            out.append(sum(seen[own[:, s]] << np.uint32(8 * s) for s in range(SAMPLES)))
        return np.concatenate(out)

    def proposed(self, windows: np.ndarray) -> np.ndarray:
        """Distinct (window, item) pairs that share a signature, as window * items + item."""
        found = []
        for own, known, order in zip(self.signs(windows), self.signed, self.order):
            a, b = np.searchsorted(known, own, "left"), np.searchsorted(known, own, "right")
            w = np.repeat(np.arange(len(own)), b - a)
            k = np.arange(len(w)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
            found.append(w * len(self.items) + order[k])
        return np.unique(np.concatenate(found))

    def distances(self, context: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Edit distance of each item to the best stretch of its context, which begins 2 * edits before the window."""
        band = 4 * self.edits + 1
        text, length, shift = self.text[item], self.length[item], np.arange(band, dtype=np.int16)
        now, best = np.zeros((len(item), band), np.int16), np.zeros(len(item), np.int64)
        for i in range(1, int(length.max()) + 1):
            new = now + (text[:, i - 1, None] != context[:, i - 1 : i - 1 + band])
            new[:, :-1] = np.minimum(new[:, :-1], now[:, 1:] + 1)
            now = np.minimum.accumulate(new - shift, axis=1) + shift
            if (done := length == i).any():
                best[done] = now[done].min(axis=1)
        return best


class Index:
    """The passages of one slice of items by length class, and their substrings."""

    def __init__(self, items: list[tuple[object, bytes]]):
        groups: dict[int, list] = {}
        for item, data in items:
            groups.setdefault(int(np.searchsorted(_starts(), len(data), "right")) - 1, []).append((item, data))
        self.classes = [Class(c, own) for c, own in sorted(groups.items())]
        grams, where = [], []
        for c, own in enumerate(self.classes):
            for _, data in own.items:
                g = _grams(np.frombuffer(data[: own.low], np.uint8))
                grams.append(g)
                where.append(c * LONGEST + np.arange(len(g)))
        pairs = np.unique(np.stack([np.concatenate(grams), np.concatenate(where).astype(np.uint64)], axis=1), axis=0)
        self.grams, first, self.count = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        self.first, self.where = first, pairs[:, 1].astype(np.int64)
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.grams * _MIX) >> np.uint64(64 - _BITS)] = True

    def windows(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(class, rows, starts) of the windows that may hold an item."""
        if len(data) < GRAM:
            return
        grams = _grams(data)
        at = np.flatnonzero(self.maybe[(grams * _MIX) >> np.uint64(64 - _BITS)])
        slot = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        row = np.searchsorted(offsets, at, "right") - 1
        real = (self.grams[slot] == grams[at]) & (at + GRAM <= offsets[row + 1])
        at, slot = at[real], slot[real]
        n = self.count[slot]
        pick = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[slot], n)
        which, implied = self.where[pick] // LONGEST, np.repeat(at, n) - self.where[pick] % LONGEST
        order = np.argsort(which, kind="stable")
        cut = np.searchsorted(which[order], np.arange(len(self.classes) + 1))
        first = np.zeros(len(data) + 1, bool)
        first[1:] = data == 32
        first[offsets] = True
        begins = np.flatnonzero(first[:-1])
        for c, own in enumerate(self.classes):
            size = own.edits + 1
            lead = 2 + LONGEST // size  # places before the first byte
            hits = np.bincount(implied[order[cut[c] : cut[c + 1]]] // size + lead, minlength=len(data) // size + 3 + lead)
            bins = np.flatnonzero(hits[:-2] + hits[1:-1] + hits[2:] >= own.need) + 1 - lead
            bins = np.unique(np.clip(bins[bins * size < len(data)], 0, None))
            if not len(bins):
                continue
            a, b = np.searchsorted(begins, bins * size), np.searchsorted(begins, (bins + 1) * size)
            start = begins[np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)]
            # and places between, since a passage may begin inside a word
            step = max(2, size // STARTS)
            start = np.unique(np.concatenate((start, (bins[:, None] * size + np.arange(0, size, step)).ravel())))
            start = start[start < len(data)]
            row = np.searchsorted(offsets, start, "right") - 1
            fits = offsets[row + 1] - start >= own.low - 2 * own.edits
            if fits.any():
                yield c, row[fits], start[fits]

    def matches(self, windows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, object, int]]:
        """(row, item, distance within the limit) of windows given as (class, rows, starts, contexts)."""
        for c in sorted({w[0] for w in windows}):
            own = self.classes[c]
            row, start, context = (np.concatenate([w[n] for w in windows if w[0] == c]) for n in (1, 2, 3))
            lead = 2 * own.edits
            for a in range(0, len(row), 4096):
                pairs = a * len(own.items) + own.proposed(context[a : a + 4096, lead : lead + own.low])
                w, k = pairs // len(own.items), pairs % len(own.items)
                _, once = np.unique(np.stack([row[w], k, start[w] // (own.edits + 1)]), axis=1, return_index=True)
                for b in range(0, len(once), 512):
                    w_, k_ = w[once[b : b + 512]], k[once[b : b + 512]]
                    far = own.distances(context[w_], k_)
                    for i in np.flatnonzero(far <= RATE * own.length[k_]):
                        yield int(row[w_[i]]), own.items[k_[i]][0], int(far[i])


def _grams(data: np.ndarray) -> np.ndarray:
    """Every run of eight bytes as one integer."""
    data = np.ascontiguousarray(data)
    return np.ndarray((max(0, len(data) - GRAM + 1),), "<u8", data, strides=(1,))


def _cut(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Stretches of one width; zero outside the row."""
    at = start[:, None] + np.arange(width)
    inside = (at >= offsets[row][:, None]) & (at < offsets[row + 1][:, None])
    return np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0)


def _folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = _FOLD[data]
    blank = data == 32
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets); one very long text comes in parts that overlap by more than an item."""
    for i, j in runs(offsets, 1 << 20, _CHUNK):
        a, end = int(offsets[i]), int(offsets[j])
        if end - a <= _CHUNK + _OVER:
            yield i, *_folded(data[a:end], offsets[i : j + 1] - a)
            continue
        for b in range(a, end, _CHUNK):
            part = data[b : min(b + _CHUNK + _OVER, end)]
            yield i, *_folded(part, np.array([0, len(part)]))


def found_in(index: Index, column: pa.Array) -> Iterator[tuple[int, object, int]]:
    """(row, item, distance) for the texts of a column."""
    held, size = [], 0
    for i, data, offsets in _parts(*flat(column)):
        for c, row, start in index.windows(data, offsets):
            own = index.classes[c]
            width = own.text.shape[1] + 4 * own.edits + 2
            held.append((c, row + i, start, _cut(data, offsets, row, start - 2 * own.edits, width)))
            size += held[-1][3].size
        if size >= _HELD:
            yield from index.matches(held)
            held, size = [], 0
    yield from index.matches(held)


def _slices(benchmark: DataFrame, item: str, text: str, size: int) -> Iterator[list[tuple[object, str]]]:
    held, total = [], 0
    for r in benchmark.where(F.octet_length(text) >= SHORTEST).select(F.col(item).alias("i"), F.col(text).alias("t")).toLocalIterator():
        held.append((r["i"], r["t"]))
        total += len(r["t"].encode())
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text", slice_bytes: int = SLICE) -> DataFrame:
    """(key, row_hash, item, distance): the smallest distance of each document row and each item that it holds.

    An item is held where some stretch of the text is within RATE of the item's length in edits, both with A-Z
    lower-cased and blanks folded, counted in bytes. Items of fewer than SHORTEST bytes name no passage; items beyond LONGEST are cut
    into passages that count each. Null texts hold nothing; an empty benchmark or table gives an empty result;
    repeated items are reported under each id, repeated rows once per key and content.
    """
    context = docs.sparkSession.sparkContext
    kinds = {"key": docs.schema[key].dataType.simpleString(), "item": benchmark.schema[item].dataType.simpleString()}
    rows = docs.select(F.col(key).alias("key"), row_hash(docs).alias(ROW_HASH), F.col(text).alias("text"))
    schema, parts = f"key {kinds['key']}, {ROW_HASH} long, item {kinds['item']}, distance int", []
    item_type = benchmark.schema[item].dataType

    def search(shared):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type

            index = None
            for batch in batches:
                if index is None:
                    index = Index(shared.value)
                got = list(found_in(index, batch.column(2)))
                at = pa.array([r for r, _, _ in got], pa.int64())
                columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array([i for _, i, _ in got], to_arrow_type(item_type)), pa.array([f for _, _, f in got], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["key", ROW_HASH, "item", "distance"])

        return rows.mapInArrow(each, schema).groupBy("key", ROW_HASH, "item").agg(F.min("distance").alias("distance"))

    for own in _slices(benchmark, item, item_text, slice_bytes):
        if known := passages(own):
            shared = context.broadcast(known)  # at most slice_bytes and one item
            parts.append(materialise(search(shared)))
            shared.unpersist()
    out = parts[0] if parts else docs.sparkSession.createDataFrame([], schema)
    for more in parts[1:]:
        out = out.unionByName(more)
    out = out.groupBy("key", ROW_HASH, "item").agg(F.min("distance").alias("distance")) if len(parts) > 1 else out
    return out.select(F.col("key").alias(key), ROW_HASH, F.col("item").alias(item), "distance")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows that hold no item, with all their columns."""
    bad = contaminated(docs, benchmark, key, text).select(F.col(key).alias("k_"), F.col(ROW_HASH).alias("h_")).distinct()
    mark = spare(docs, "mark_of_row")
    marked = docs.withColumn(mark, row_hash(docs))
    return marked.join(bad, marked[key].eqNullSafe(bad["k_"]) & (marked[mark] == bad["h_"]), "left_anti").drop(mark)
