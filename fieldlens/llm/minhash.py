"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A document is the set of its distinct word shingles. Its signature has symbols of ``BITS`` bits, each cut from the smallest
value of one hash function over the set. Two signatures with ``d`` different symbols have, by the pigeonhole principle,
a chunk with at most ``d // CHUNKS`` of them. Every chunk is indexed once for each single error that it may have (that
symbol is left out), so all pairs of at most ``2 * CHUNKS - 1`` different symbols meet under some key. A pair just at
the threshold's similarity meets under none with a probability of 3e-7.

Pairs are confirmed on the full sets, and only those that can matter are made:

1. Equal sets are folded to one node, so copies cost one row.
2. Under each key every node meets the smallest node only. Confirmed links give components.
3. Keys under which several components still meet are put together to families, such that all nodes of a key are in
   one. Families are gone through whole: blocks of their nodes meet in tasks, where one matrix product gives the exact
   intersections of all their sets, and the links come out as a forest. Nothing is left out, and a group of copies,
   which is one component by then, is no family.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.columnar import flat, runs
from fieldlens.llm.common import materialise, small_batches
from fieldlens.llm.graph import components

SHINGLE, PERCENT = 3, 85
CHUNKS, WIDTH, BITS = 10, 6, 10
SYMBOLS = CHUNKS * WIDTH
BLOCK, BLOCK_HASHES, ROWS = 512, 1 << 20, 1000
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SLICE, _CELLS, _COLUMNS = 2 << 20, 1 << 14, 1 << 12
_SEEDS = np.random.default_rng(42).integers(1, 1 << 63, (2, SYMBOLS), dtype=np.uint64) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words: one for the whole sequence; none: empty."""
    words = [t.translate(_LOWER).split() for t in texts]
    coded = pa.array([w for own in words for w in own], pa.binary()).dictionary_encode()
    known = np.array([int.from_bytes(hashlib.blake2b(w.as_py(), digest_size=8).digest(), "little") for w in coded.dictionary], np.uint64)
    word = known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else known
    n = np.array([len(own) for own in words], np.int64)
    start = np.concatenate(([0], np.cumsum(n)))
    full = max(0, len(word) - shingle + 1)
    hashes = np.zeros(full, np.uint64)
    for k in range(shingle):
        hashes = _mix(hashes + word[k : k + full])
    out = []
    for i, size in enumerate(n):
        if size >= shingle:
            out.append(np.unique(hashes[start[i] : start[i] + size - shingle + 1]))
        else:
            h = np.zeros(min(size, 1), np.uint64)
            for k in range(size):
                h = _mix(h + word[start[i] + k])
            out.append(h)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(set, symbol): BITS bits of the smallest value under each hash function; empty sets have zeros."""
    size = np.array([len(s) for s in sets], np.int64)
    least = np.full((len(sets), SYMBOLS), np.iinfo(np.uint64).max, np.uint64)
    offsets = np.concatenate(([0], np.cumsum(size)))
    whole = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    for i, j in runs(offsets, 1 << 20, _CELLS):
        some = i + np.flatnonzero(size[i:j])
        if not len(some):
            continue
        for a in range(offsets[i], offsets[j], _CELLS):  # a very large set comes in parts
            b = min(a + _CELLS, offsets[j])
            part, cut = whole[a:b], np.maximum(offsets[some] - a, 0)
            for s in range(SYMBOLS):
                least[some, s] = np.minimum(least[some, s], np.minimum.reduceat(part * _SEEDS[0, s] + _SEEDS[1, s], cut))
    return ((least >> np.uint64(20)) & np.uint64((1 << BITS) - 1)).astype(np.uint16)


def keys(signs: np.ndarray) -> np.ndarray:
    """(signature, chunk and hole): the chunk's symbols without the one at the hole, told apart by chunk and hole."""
    out = np.empty((len(signs), SYMBOLS), np.int64)
    for c in range(CHUNKS):
        own = signs[:, c * WIDTH : (c + 1) * WIDTH].astype(np.int64)
        for hole in range(WIDTH):
            code = np.full(len(signs), c * WIDTH + hole, np.int64)
            for s in range(WIDTH):
                if s != hole:
                    code = code << BITS | own[:, s]
            out[:, c * WIDTH + hole] = code
    return out


def _coded(signs: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(signs)], pa.binary())


def _decoded(column: pa.Array) -> np.ndarray:
    return flat(column)[0].view(np.uint16).reshape(-1, SYMBOLS) if len(column) else np.empty((0, SYMBOLS), np.uint16)


def _texts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    sizes = np.diff(flat(column)[1])
    for i, j in runs(np.concatenate(([0], np.cumsum(sizes))), 1 << 20, _SLICE):
        yield i, [(t or "").encode() for t in column.slice(i, j - i).to_pylist()]


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _describe(shingle: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, texts in _texts(batch.column(1)):
                sets = shingle_sets(texts, shingle)
                n, name = pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary())
                columns = [batch.column(k).slice(i, len(texts)) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays([*columns, n, name, _coded(signatures(sets))], ["key", "content", "n", "name", "signs"])

    return each


def _sets_of(shingle: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(1).to_pylist()
            for i, texts in _texts(batch.column(2)):
                sets = shingle_sets(texts, shingle)
                own = [k for k, s in enumerate(sets) if _digest(s) == names[i + k]]
                if own:
                    bounds = pa.array(np.concatenate(([0], np.cumsum([len(sets[k]) for k in own]))), pa.int32())
                    values = pa.array(np.concatenate([sets[k] for k in own]).view(np.int64))
                    node = batch.column(0).take(pa.array([i + k for k in own]))
                    yield pa.RecordBatch.from_arrays([node, pa.ListArray.from_arrays(bounds, values)], ["node", "hashes"])

    return each


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = keys(_decoded(batch.column(1)))
        node = np.repeat(batch.column(0).to_numpy(), SYMBOLS)
        yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), pa.array(node)], ["k", "node"])


def furthest(percent: int) -> int:
    """So many different symbols, of all, that a pair at the threshold has more with a probability under 1e-9."""
    p, rest = 1 - percent / 100, 0.0
    for d in range(SYMBOLS, 0, -1):
        rest += comb(SYMBOLS, d) * p**d * (1 - p) ** (SYMBOLS - d)
        if rest > 1e-9:
            return d
    return 0


def _possible(percent: int):
    """Whether sizes and signatures allow a link, for pairs with both ends' columns."""
    limit = furthest(percent)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _decoded(batch.column(2)), _decoded(batch.column(3))
            yield batch.select([0, 1]).filter(pa.array((a != b).sum(axis=1) <= limit))

    return each


def common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """(set of one, set of two): how many hashes both have."""
    sizes = np.array([len(x) for x in one + two])
    values, which, seen = np.unique(np.concatenate(one + two), return_inverse=True, return_counts=True)
    keep = seen[which] > 1  # a hash of a single set is in no intersection
    row, number = np.repeat(np.arange(len(sizes)), sizes)[keep], np.cumsum(seen > 1)[which[keep]] - 1
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    out = np.zeros((len(one), len(two)), np.float64)
    cut = np.searchsorted(number, np.arange(0, int((seen > 1).sum()) + _COLUMNS, _COLUMNS))
    for k, (a, b) in enumerate(zip(cut, cut[1:])):
        table = np.zeros((len(sizes), _COLUMNS), np.float32)
        table[row[a:b], number[a:b] - k * _COLUMNS] = 1
        out += table[: len(one)] @ table[len(one) :].T
    return out


def _forest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[int]:
    """The links that join different components, one after the other."""
    root = {x: x for x in label.tolist()}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for k, (x, y) in enumerate(zip(label[a].tolist(), label[b].tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            yield k


def _across(percent: int):
    """Links between different labels inside the blocks that share (family, x, y); rows come sorted by these."""

    def links(side, label, sets):
        one, two = np.flatnonzero(side <= 0), np.flatnonzero(side != 0)  # -1: a block against itself
        if not len(one) or not len(two):
            return
        n = np.array([len(x) for x in sets])
        both = common([sets[k] for k in one], [sets[k] for k in two])
        linked = (label[one][:, None] != label[two]) & (100 * both >= percent * (n[one][:, None] + n[two] - both))
        i, j = np.nonzero(linked)
        i, j = one[i], two[j]
        chosen = np.array(list(_forest(label, i, j)), np.int64)
        if len(chosen):
            yield pa.RecordBatch.from_arrays([pa.array(label[i[chosen]]), pa.array(label[j[chosen]])], ["a", "b"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            side, label = (batch.column(k).to_numpy() for k in range(3, 5))
            hashes, at = np.asarray(batch.column(5).flatten()), np.asarray(batch.column(5).offsets).astype(np.int64)
            at -= at[0]
            edge = np.flatnonzero(np.append(True, (group[1:] != group[:-1]).any(axis=1)))
            for a, b in zip(edge, np.append(edge[1:], len(group))):
                if now != tuple(group[a]):
                    if held:
                        yield from links(*_joined(held))
                    now, held = tuple(group[a]), []
                held.append((side[a:b], label[a:b], [hashes[at[k] : at[k + 1]] for k in range(a, b)]))
        if held:
            yield from links(*_joined(held))

    return each


def _joined(held: list) -> tuple:
    side, label, sets = zip(*held)
    return np.concatenate(side), np.concatenate(label), [x for own in sets for x in own]


class _Corpus:
    """The rows and the folded nodes of a table, and confirmation of pairs on its full sets."""

    def __init__(self, docs: DataFrame, key: str, text: str, shingle: int, percent: int):
        self.percent, self.shingle = percent, shingle
        body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
        self.texts = docs.select(body.alias("text"), F.xxhash64(body).alias("content"))
        rows = docs.select(F.col(f"`{key}`").alias("key"), body.alias("text"), F.xxhash64(body).alias("content"))
        kind = docs.schema[key].dataType.simpleString()
        self.rows = materialise(rows.mapInArrow(_describe(shingle), f"key {kind}, content bigint, n bigint, name binary, signs binary"))
        # what a set's rows share is taken with the smallest content hash, whose text stands for the set
        one = F.min(F.struct("content", "n", "signs")).alias("one")
        folded = self.rows.where("n > 0").groupBy("name").agg(F.min("key").alias("first"), one).select("name", "first", "one.*")
        self.nodes = materialise(folded.withColumn("node", F.monotonically_increasing_id()))

    def possible(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) without those that sizes or signatures rule out."""
        end = lambda side: self.nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("signs").alias(f"s_{side}"))
        both = pairs.distinct().join(end("a"), "a").join(end("b"), "b")
        both = both.where(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")).select("a", "b", "s_a", "s_b")
        return materialise(both.mapInArrow(_possible(self.percent), "a bigint, b bigint"))

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(node, hashes) of the wanted nodes; wanted: (node)."""
        wanted = materialise(wanted.distinct().join(self.nodes.select("node", "content", "name"), "node"))
        # texts are found by a hash; where two texts share it, the set's name decides
        found = self.texts.join(wanted, "content").select("node", "name", "text").distinct()
        with small_batches(self.nodes.sparkSession, ROWS):
            return materialise(found.mapInArrow(_sets_of(self.shingle), "node bigint, hashes array<bigint>"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar enough."""
        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        end = lambda side, name: sets.select(F.col("node").alias(side), F.col("hashes").alias(name))
        both = pairs.join(end("a", "x"), "a").join(end("b", "y"), "b")
        shared = F.size(F.array_intersect("x", "y"))
        return materialise(both.where(100 * shared >= self.percent * (F.size("x") + F.size("y") - shared)).select("a", "b"))

    def between(self, members: DataFrame) -> DataFrame:
        """Pairs of labels (a, b) that join all that linked nodes of a family have; members: (node, label, family)."""
        sized = members.join(self.nodes.select("node", "n"), "node")
        blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_HASHES)).alias("blocks")
        blocks = materialise(sized.groupBy("family").agg(blocks))
        mine, other = F.pmod(F.xxhash64("node"), F.col("blocks")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        dealt = sized.join(blocks, "family").select("family", "node", "label", mine.alias("mine"), other.alias("other"))
        side = F.when(F.col("mine") == F.col("other"), -1).otherwise((F.col("mine") > F.col("other")).cast("int"))
        dealt = dealt.select("family", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), side.alias("side"), "node", "label")
        dealt = dealt.join(self.sets(members.select("node")), "node").select("family", "x", "y", "side", "label", "hashes")
        dealt = dealt.repartition("family", "x", "y").sortWithinPartitions("family", "x", "y")
        with small_batches(self.nodes.sparkSession, ROWS):
            return materialise(dealt.mapInArrow(_across(self.percent), "a bigint, b bigint"))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: key, n_shingles, component_id.

    A-Z count as lower case, blanks (space, tab to carriage return) separate words. Rows are linked where the distinct
    shingles that both have are at least ``percent`` hundredths of those that either has; equal sets always are.
    component_id is the smallest key that can be reached, null only where every key of the component is null. Rows
    without a word (null, empty or blank texts) have n_shingles 0 and stand alone under their own key. Repeated rows
    count each, other columns do not matter, an empty table gives an empty result.
    """
    corpus = _Corpus(docs, key, text, shingle, percent)
    nodes = corpus.nodes
    keyed = nodes.select("node", "signs").mapInArrow(_key_rows, "k bigint, node bigint")
    # partial aggregates take the weight of a key that many nodes share
    ends = keyed.groupBy("k").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    ends = materialise(ends.select("k", "least"))
    met = materialise(keyed.join(ends, "k"))
    stars = corpus.possible(met.where("node > least").select(F.col("least").alias("a"), F.col("node").alias("b")))
    links = corpus.confirmed(stars)
    labels = components(links)
    labelled = materialise(met.join(labels, "node", "left").select("k", "node", F.coalesce("label", "node").alias("label")))
    apart = labelled.groupBy("k").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    apart = materialise(apart.select("k", "low"))
    final = nodes.join(labels, "node", "left").select("name", "first", F.coalesce("label", "node").alias("label"))
    if not apart.isEmpty():
        meet = materialise(labelled.join(apart, "k"))
        # keys of one smallest label, and keys that share a node with those, make up a family
        lowest = materialise(meet.groupBy("node").agg(F.min("low").alias("lowest")))
        meet = materialise(meet.join(lowest, "node").select("k", "node", "label", "lowest"))
        family = materialise(meet.groupBy("k").agg(F.min("lowest").alias("family")))
        members = materialise(meet.join(family, "k").select("node", "label", "family").distinct())
        more = corpus.between(members)
        if not more.isEmpty():
            joined = components(more).select(F.col("node").alias("label"), F.col("label").alias("of"))
            final = final.join(joined, "label", "left").select("name", "first", F.coalesce("of", "label").alias("label"))
    named = materialise(final)
    least = materialise(named.groupBy("label").agg(F.min("first").alias("component_id")))
    found = materialise(named.join(least, "label").select("name", "component_id"))
    out = corpus.rows.select("key", "n", "name").join(found, "name", "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"))
