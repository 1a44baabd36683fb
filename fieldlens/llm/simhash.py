"""SimHash near-duplicates with pivot distance tables.

Fingerprints are made in one pass over the texts. Equal ones are folded first, so copies cost one row. Pairs that
differ in few bits agree in some of the blocks that 64 bits are cut into, so fingerprints are dealt by every choice of
blocks that must agree. Inside such a bucket a table of Hamming distances to reference fingerprints discards pairs: by
the triangle inequality, distances to one reference differ by no more than the pair's own distance. What survives is
verified bit by bit. A bucket returns a forest with its components instead of its pairs, and visits each member once:
members that are already reached are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import BLANKS, ROW_HASH, keep_rows, materialise, row_hash
from fieldlens.llm.graph import components

SHINGLE, BITS, SEED, PIVOTS, FANOUT = 4, 4, 42, 32, 64
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_CUT = 1 << 16


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 hashes of word shingles; no words: zero."""
    words = data.translate(_LOWER).split()
    if not words:
        return 0
    data, total = b" ".join(words), np.zeros(64, dtype=np.int64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest, last = xxhash.xxh64_intdigest, ends[min(shingle, len(words)) - 1 :].tolist()
    first = starts[:n].tolist()
    for at in range(0, n, _CUT):
        h = np.array([digest(data[a:b], SEED) for a, b in zip(first[at : at + _CUT], last[at : at + _CUT])], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()) if pa.types.is_string(batch.column(2).type) else batch.column(2).cast(pa.large_binary())
            found = np.array([fingerprint(t.as_py() or b"", shingle) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["key", ROW_HASH, "fp"])

    return each


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, row_hash, fp) per row; words are split at blanks, A-Z lower-cased, null text is empty."""
    rows = docs.select(F.col(key).alias("key"), row_hash(docs).alias(ROW_HASH), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(_fingerprints(shingle), f"key {kind}, {ROW_HASH} long, fp long")


def tables(n: int, bits: int) -> list[int]:
    """Masks of block choices: 64 bits in k blocks, all choices of k - bits, with k so large that random buckets stay small."""
    k = bits + 1
    while 64 * (k - bits) // k < 60 and 4 << (64 * (k - bits) // k) < n:
        k += 1
    edges = [64 * i // k for i in range(k + 1)]
    blocks = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(k)]
    return [sum(c) for c in combinations(blocks, k - bits)]


def _forest(fp: np.ndarray, pivots: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the same components as all pairs within ``bits``."""
    far = np.bitwise_count(fp[:, None] ^ pivots[None, :]).astype(np.int16)
    left, a, b = np.arange(len(fp)), [], []
    while len(left) > 1:
        reach, left = [int(left[0])], left[1:]
        while reach and len(left):
            x = reach.pop()
            near = left
            for j in range(far.shape[1]):
                near = near[np.abs(far[near, j] - far[x, j]) <= bits]
                if len(near) < 8:
                    break
            near = near[np.bitwise_count(fp[near] ^ fp[x]) <= bits]
            if len(near):
                up = np.concatenate(([x], near[(np.arange(1, len(near)) - 1) // FANOUT]))  # a tree of bounded degree
                a.append(near)
                b.append(up)
                left = left[~np.isin(left, near, assume_unique=True)]
                reach.extend(near.tolist())
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(a), np.concatenate(b)


def _links(pivots: list[int], bits: int):
    refs = np.array(pivots, dtype=np.int64).view(np.uint64)

    def small(fp, run, size):
        """Verified pairs of the many small buckets, all at once, by distance in the order."""
        for step in range(1, size):
            i = np.flatnonzero(run[:-step] == run[step:])
            if not len(i):
                return
            for p in refs:
                i = i[np.abs(np.bitwise_count(fp[i] ^ p).astype(np.int16) - np.bitwise_count(fp[i + step] ^ p)) <= bits]
                if len(i) < 64:
                    break
            i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= bits]
            yield fp[i], fp[i + step]

    def edges(fp, run):
        counts = np.bincount(run)
        if (tiny := (counts[run] > 1) & (counts[run] <= 8)).any():
            yield from small(fp[tiny], run[tiny], 8)
        order = np.concatenate(([0], np.cumsum(counts)))
        for r in np.flatnonzero(counts > 8):
            own = fp[order[r] : order[r + 1]]
            a, b = _forest(own, refs, bits)
            yield own[a], own[b]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out(parts):
            t, k, fp = (np.concatenate(x) for x in zip(*parts))
            run = np.concatenate(([0], np.cumsum((t[1:] != t[:-1]) | (k[1:] != k[:-1]))))
            for a, b in edges(fp, run):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t, k, fp = (np.asarray(batch.column(i)) for i in range(3))
            fp = fp.view(np.uint64)
            cut = np.flatnonzero((t != t[-1]) | (k != k[-1]))
            at = int(cut[-1]) + 1 if len(cut) else 0  # the last bucket may go on in the next batch
            if held and (held[0][0][0] != t[0] or held[0][1][0] != k[0]):
                yield from out(held)
                held = []
            if at:
                held.append((t[:at], k[:at], fp[:at]))
                yield from out(held)
                held = []
            held.append((t[at:], k[at:], fp[at:]))
        if held:
            yield from out(held)

    return each


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Per row of ``docs``: key, fingerprint (hex), component_id, component_rank, row_hash.

    Fingerprints of at most ``bits`` different bits are linked; component_id is the smallest key that can be reached,
    null only where every key of the component is null. Rows without a word have fingerprint zero and are linked like
    any other. Repeated rows count each; an empty table gives an empty result.
    """
    rows = materialise(fingerprints(docs, key, text, shingle))
    nodes = materialise(rows.groupBy("fp").agg(F.min("key").alias("first")))
    n = nodes.count()
    masks = [m - (1 << 64) if m >> 63 else m for m in tables(n, bits)]
    pivots = [r[0] for r in nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(PIVOTS).collect()]
    dealt = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "k"))
    dealt = dealt.repartition("t", "k").sortWithinPartitions("t", "k", "fp").select("t", "k", "fp")
    edges = dealt.mapInArrow(_links(pivots, bits), "a long, b long")
    labels = components(edges)
    named = nodes.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    named = materialise(named)
    least = materialise(named.groupBy("label").agg(F.min("first").alias("component_id")))
    found = materialise(named.join(least, "label").select("fp", "component_id", "label"))
    return rows.join(found, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.lower(F.lpad(F.hex("label"), 16, "0")).alias("component"), ROW_HASH,
    )


def drop_near(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row of each group, with all its columns: the smallest key, then the smallest row hash; null keys last."""
    groups = near_groups(docs, key, text, shingle, bits)
    first = F.min(F.struct(F.col(key).isNull().alias("u"), F.col(key).alias("k"), F.col(ROW_HASH).alias("h")))
    chosen = groups.groupBy("component").agg(first.alias("first"))
    return keep_rows(docs, chosen.select(F.col("first.k").alias(key), F.col("first.h").alias(ROW_HASH)), key)
