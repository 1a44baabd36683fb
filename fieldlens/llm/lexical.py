"""Ranked lexical search over a length-stratified index.

The score of a document depends on its length through one whole number m only. Documents of equal m form a stratum, and
inside it the postings of a term are grouped by the number of occurrences tf, so an impact is computed once for each
(term, tf) and holds for all documents of the posting. An index row is one stratum of one slice of the documents: texts
are never shuffled, a stratum that holds a third of all documents is simply many rows, and every row of the table is
indexed.

The greatest tf of each term in a stratum bounds what a query can score there, and the bounds order the visits. First
every query visits its most promising stratum of each slice; the scores found give a floor for the whole index. Then only
strata whose bound reaches the floor are visited. Strata that are passed over cannot hold any of the best documents, so
the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.columnar import flat, runs, word_spans
from fieldlens.llm.common import discard, materialise, small_batches, written

TOP, FLAT, SLOPE = 10, 25, 75  # m = FLAT + SLOPE * n / mean n
SLICE_BYTES, SLICE_ITEMS, INDEX_ROWS, ROWS = 8 << 20, 2000, 500, 2000
_PART, _CELLS, _EXACT = 2 << 20, 1 << 19, 1 << 53
_LETTER = np.ones(256, bool)
_LETTER[:128] = [chr(b).isalnum() for b in range(128)]
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


def _expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), start[1], ..."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)


def _parts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, folded bytes, offsets) of slices of the column; a text is never cut."""
    data, offsets = flat(column)
    for i, j in runs(offsets, 1 << 20, _PART):
        yield i, _FOLD[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row of each term, its number among the distinct terms, distinct terms): runs of letters, digits and non-ASCII."""
    row, start, end = word_spans(data, offsets, _LETTER)
    size = end - start
    at = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    bare = np.ascontiguousarray(data[_expand(start, size)])
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(bare)]).dictionary_encode()
    return row, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def lengths(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, all their terms with repeats); docs: (key, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = whole = 0
        for batch in batches:
            for _, data, offsets in _parts(batch.column(0)):
                n = np.bincount(word_spans(data, offsets, _LETTER)[0], minlength=1)
                some, whole = some + int((n > 0).sum()), whole + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array([some]), pa.array([whole])], ["n", "l"])

    r = docs.select("text").mapInArrow(count, "n bigint, l bigint").agg(F.sum("n"), F.sum("l")).first()
    return r[0] or 0, r[1] or 0


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary per stratum, of the 32-bit numbers between its bounds."""
    data = pa.py_buffer(np.ascontiguousarray(values, np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((4 * bounds).astype(np.int32)), data])


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of packed binaries, bounds of each row)."""
    data, offsets = flat(column)
    return np.ascontiguousarray(data).view(np.int32).astype(np.int64), offsets // 4


def index(docs: DataFrame, n: int, total: int) -> DataFrame:
    """One row per stratum and slice; docs: (key, text).

    ``docs`` are the keys and ``terms`` the distinct terms, a line each. The rest are packed 32-bit numbers: for every
    term how many tf groups it has, for every group its tf (ascending) and how many documents, for every posting the
    document's place in ``docs``. Documents without a term have no stratum.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, offsets in _parts(batch.column(1)):
                row, term, known = terms(data, offsets)
                if not len(row):
                    continue
                size = np.bincount(row, minlength=len(offsets) - 1)
                used = np.flatnonzero(size)
                each_size, of = np.unique(size[used], return_inverse=True)
                m = np.array([FLAT + SLOPE * int(s) * n // total for s in each_size], np.int64)[of]
                order = np.argsort(m, kind="stable")
                used = used[order]
                strata, stratum, docs_in = np.unique(m[order], return_inverse=True, return_counts=True)
                place = np.zeros(len(size), np.int64)
                place[used] = np.arange(len(used))
                code, tf = np.unique(place[row] * np.int64(len(known)) + term, return_counts=True)
                doc, term = code // len(known), code % len(known)
                of = stratum[doc]
                order = np.lexsort((doc, tf, term, of))
                doc, term, tf, of = doc[order], term[order], tf[order], of[order]
                change = lambda *c: np.flatnonzero(np.append(True, np.any([x[1:] != x[:-1] for x in c], axis=0)))
                groups, words = change(of, term, tf), change(of, term)
                at = np.searchsorted(of, np.arange(len(strata) + 1))
                by_group, by_word = np.searchsorted(groups, at), np.searchsorted(words, at)
                word = known.take(pa.array(term[words]))
                docs_at = np.concatenate(([0], np.cumsum(docs_in)))
                lines = [b"\n".join(word.slice(a, b - a).to_pylist()) for a, b in zip(by_word, by_word[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(strata), pa.ListArray.from_arrays(pa.array(docs_at, pa.int32()), batch.column(0).slice(i, len(size)).take(pa.array(used))),
                        pa.array(lines, pa.binary()), _packed(np.diff(np.append(np.searchsorted(groups, words), len(groups))), by_word),
                        _packed(tf[groups], by_group), _packed(np.diff(np.append(groups, len(of))), by_group), _packed(doc - docs_at[of], at),
                    ],
                    ["m", "docs", "terms", "groups", "tf", "holders", "places"],
                )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "text").mapInArrow(each, f"m bigint, docs array<{kind}>, terms binary, groups binary, tf binary, holders binary, places binary")


@dataclass
class Queries:
    """The items of one slice: for every term the items that have it, and its weight."""

    number: dict[bytes, int]
    begin: np.ndarray  # term -> its first entry below
    item: np.ndarray
    times: np.ndarray  # occurrences of the term in the item
    items: int
    weight: np.ndarray | None = None
    wide: bool = False  # sums may pass the whole numbers that doubles hold

    @staticmethod
    def of(texts: list[str | None]) -> Queries:
        data, offsets = flat(pa.array(texts, pa.string()))
        row, term, known = terms(_FOLD[data], offsets)
        code, times = np.unique(term * np.int64(max(len(texts), 1)) + row, return_counts=True)
        begin = np.searchsorted(code, np.arange(len(known) + 1) * len(texts))
        return Queries({t.as_py(): k for k, t in enumerate(known)}, begin, code % max(len(texts), 1), times.astype(np.int64), len(texts))

    def weigh(self, n: int, df: dict[int, int]) -> Queries:
        at = [df.get(k, 0) for k in range(len(self.number))]
        self.weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) if d else 0 for d in at], np.int64)
        most = np.bincount(self.item, weights=self.times * np.repeat(self.weight, np.diff(self.begin)) * 1e6, minlength=1)
        self.wide = bool(most.max() >= _EXACT)
        return self

    def add(self, cell: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
        """Exact sums of whole numbers per cell."""
        if not self.wide:
            return np.bincount(cell, weights=value, minlength=size).astype(np.int64)
        out = np.zeros(size, np.int64)
        np.add.at(out, cell, value)
        return out


class Strata:
    """The part of some index rows that queries ask for: an entry for each stratum and term."""

    def __init__(self, batch: pa.RecordBatch, queries: Queries):
        data, _ = flat(batch.column("terms"))
        groups, own = _numbers(batch.column("groups"))
        end = np.ones(len(groups), np.int64)  # a term's bytes and the line end, missing after a row's last
        end[own[1:][np.diff(own) > 0] - 1] = 0
        breaks = np.flatnonzero(data == 10)
        stop = np.empty(len(groups), np.int64)
        stop[end == 1] = breaks
        bounds = flat(batch.column("terms"))[1]
        stop[end == 0] = bounds[1:][np.diff(own) > 0]
        start = np.concatenate(([0], (stop + end)[:-1]))
        size = stop - start
        bare = np.ascontiguousarray(data[data != 10])
        at = np.concatenate(([0], np.cumsum(size)))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(bare)]).dictionary_encode()
        known = np.array([queries.number.get(t.as_py(), -1) for t in coded.dictionary], np.int64)
        number = known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else known
        entry = np.flatnonzero(number >= 0)
        self.row, self.term, self.rows = np.searchsorted(own, entry, "right") - 1, number[entry], len(batch)
        self.holders, _ = _numbers(batch.column("holders"))
        begin = np.concatenate(([0], np.cumsum(groups)))
        self.groups, self.group = groups[entry], begin[entry]
        self.posting = np.concatenate(([0], np.cumsum(self.holders)))
        self.seen = self.posting[self.group + self.groups] - self.posting[self.group]
        if "docs" in batch.schema.names:
            docs = batch.column("docs")
            self.docs_at = np.asarray(docs.offsets).astype(np.int64)
            self.docs_at, self.keys = self.docs_at - self.docs_at[0], docs.flatten()
            self.tf, self.places = _numbers(batch.column("tf"))[0], _numbers(batch.column("places"))[0]
            self.m = batch.column("m").to_numpy()
            self.best = self.impact(self.group + self.groups - 1, self.row)

    def impact(self, group: np.ndarray, row: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * self.tf[group] // (1000 * self.tf[group] + 8 * self.m[row])

    def bounds(self, q: Queries) -> np.ndarray:
        """(item, stratum): what the item can score there at most."""
        n = np.diff(q.begin)[self.term]
        on = _expand(q.begin[self.term], n)
        top = np.repeat(self.best * q.weight[self.term], n) * q.times[on]
        return q.add(q.item[on] * self.rows + np.repeat(self.row, n), top, q.items * self.rows).reshape(q.items, self.rows)

    def scores(self, q: Queries, visit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, document, score) above 0 of the visited (item, stratum) cells, documents as places in ``keys``."""
        group, row = _expand(self.group, self.groups), np.repeat(self.row, self.groups)
        impact = self.impact(group, row)  # once per term, tf and stratum
        begin, count = self.posting[group], self.holders[group]
        lead = np.cumsum(self.groups) - self.groups
        n = np.diff(q.begin)[self.term]
        entry, on = np.repeat(np.arange(len(self.term)), n), _expand(q.begin[self.term], n)
        go = visit[q.item[on], self.row[entry]]
        entry, on = entry[go], on[go]
        order = np.lexsort((q.item[on], self.row[entry]))
        entry, on = entry[order], on[order]
        cell = np.flatnonzero(np.diff(self.row[entry] * np.int64(q.items) + q.item[on], prepend=-1))  # cells of one item and stratum
        work = np.concatenate(([0], np.cumsum(self.seen[entry])))
        for i, j in runs(work[np.append(cell, len(entry))], 1 << 20, _CELLS):
            a, b = cell[i], cell[j] if j < len(cell) else len(entry)
            own, k = entry[a:b], self.groups[entry[a:b]]
            g = _expand(lead[own], k)
            width = np.diff(self.docs_at)[self.row[entry[cell[i:j]]]]
            base = np.cumsum(width) - width
            at_cell = np.repeat(np.repeat(np.arange(j - i), np.diff(np.append(cell[i:j], b))), k)
            value = np.repeat(np.repeat(q.weight[self.term[own]] * q.times[on[a:b]], k) * impact[g], count[g])
            spot = np.repeat(base[at_cell], count[g]) + self.places[_expand(begin[g], count[g])]
            total = q.add(spot, value, int(width.sum()))
            found = np.flatnonzero(total)
            which = np.searchsorted(base, found, "right") - 1
            yield q.item[on[cell[i:j]]][which], found - base[which] + self.docs_at[self.row[entry[cell[i:j]]]][which], total[found]


def _slices(batch: pa.RecordBatch, q: Queries) -> Iterator[pa.RecordBatch]:
    """Index rows in parts whose bounds take bounded space, one row at least."""
    step = max(1, _CELLS // (len(q.item) + q.items))
    for i in range(0, len(batch), step):
        yield batch.slice(i, step)


def _best(found: pa.Table, top: int) -> tuple[pa.Table, pa.Table]:
    """The ``top`` rows of every item, and the rows at the last place."""
    found = found.take(pc.sort_indices(found, sort_keys=[("item", "ascending"), ("score", "descending"), ("key", "ascending")]))
    item = found.column("item").to_numpy()
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return found.filter(pa.array(place < top)), found.filter(pa.array(place == top - 1))


def _visit(shared, floors: np.ndarray | None, top: int):
    """The best documents of each task: of every item's most promising strata, or of all that reach the floors."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        floor = np.ones(q.items, np.int64) if floors is None else np.maximum(floors, 1)
        held = None
        for batch in batches:
            for part in _slices(batch, q):
                strata = Strata(part, q)
                bound = strata.bounds(q)
                visit = bound >= floor[:, None]
                if floors is None:
                    visit &= np.arange(strata.rows) == bound.argmax(axis=1)[:, None]
                for item, doc, score in strata.scores(q, visit):
                    good = score >= floor[item]
                    if not good.any():
                        continue
                    new = pa.table({"item": item[good], "score": score[good], "key": strata.keys.take(pa.array(doc[good]))})
                    held, last = _best(new if held is None else pa.concat_tables([held, new]), top)
                    floor[last.column("item").to_numpy()] = last.column("score").to_numpy()
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return each


def _ranked(frame: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _item_slices(items: DataFrame) -> Iterator[list]:
    held, size = [], 0
    for r in items.toLocalIterator():
        held.append((r["id"], r["text"]))
        size += len((r["text"] or "").encode())
        if size >= SLICE_BYTES or len(held) >= SLICE_ITEMS:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """The ``top`` documents of every row of ``items``: item, rank (from 1), key, score above 0; equal scores by key, null last.

    Terms are the maximal runs of ASCII letters, ASCII digits and all other code points beyond ASCII; only A-Z are lower-cased.
    N documents have a term, L terms in all; df documents hold a term, tf times each. A term weighs
    floor(1000 * ln((2N + 2) / (2df + 1))) and gives weight * (10^9 * tf div (1000 * tf + 8m)) for each time that the
    item has it, where m = 25 + 75 * n * N div L for a document of n terms. Null and empty texts have no term: such
    documents are never found, such items find nothing. Repeated documents and repeated items count each; other columns
    do not matter; empty tables give an empty result. Items come in slices of bounded size, each shared with all tasks.
    """
    spark = docs.sparkSession
    kinds = {"key": docs.schema[key].dataType.simpleString(), "item": items.schema[item].dataType}
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    asked = items.select(F.col(f"`{item}`").alias("id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    out = T.StructType([T.StructField("id", kinds["item"]), T.StructField("item", T.LongType())])
    with small_batches(spark, ROWS):
        n, total = lengths(rows)
        folder = written(index(rows, n, total), "lexical") if n else None
    found = []
    if folder:
        strata = spark.read.parquet(folder)
        with small_batches(spark, INDEX_ROWS):  # index rows are large
            for own in _item_slices(asked):
                queries = Queries.of([t for _, t in own])
                if not queries.number:
                    continue
                plain = spark.sparkContext.broadcast(queries)  # SLICE_BYTES of text and SLICE_ITEMS items at most

                def seen(batches: Iterator[pa.RecordBatch], plain=plain) -> Iterator[pa.RecordBatch]:
                    df = np.zeros(len(plain.value.number), np.int64)
                    for batch in batches:
                        own = Strata(batch, plain.value)
                        df += np.bincount(own.term, weights=own.seen, minlength=len(df)).astype(np.int64)
                    at = np.flatnonzero(df)
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])

                counted = strata.select("terms", "groups", "holders").mapInArrow(seen, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
                queries.weigh(n, {r["term"]: r["df"] for r in counted.collect()})  # the slice's terms
                weighed = spark.sparkContext.broadcast(queries)
                schema = f"item bigint, score bigint, key {kinds['key']}"
                first = _ranked(strata.mapInArrow(_visit(weighed, None, top), schema), top).where(F.col("rank") == top).select("item", "score")
                floors = np.zeros(len(own), np.int64)
                for r in first.collect():  # a row per item of the slice
                    floors[r["item"]] = r["score"]
                best = _ranked(strata.mapInArrow(_visit(weighed, floors, top), schema), top)
                names = spark.createDataFrame([(i, k) for k, (i, _) in enumerate(own)], out)
                found.append(materialise(best.join(names, "item").select("id", F.col("rank").cast("int").alias("rank"), "key", "score")))
                plain.unpersist()
                weighed.unpersist()
        discard(spark, folder)
    empty = spark.createDataFrame([], f"id {kinds['item'].simpleString()}, rank int, key {kinds['key']}, score bigint")
    result = found[0] if found else empty
    for more in found[1:]:
        result = result.unionByName(more)
    return result.select(F.col("id").alias(item), "rank", F.col("key").alias(key), "score")
