"""Quality by nearest-neighbour voting in a latent-semantic space.

A document is described by counts of byte triples (hashed), of triples of character classes, and by how evenly its
triples are spread. A bounded sample of labelled documents gives inverse document frequencies and, by a truncated
singular value decomposition, the latent space; its vectors with their labels are broadcast. Every document is
compared with all of them by exact cosine products, block by block, and its nearest neighbours vote with their
similarity, corrected from the balanced sample to the class counts of all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.columnar import flat, runs, unit
from fieldlens.llm.common import held_out

SAMPLE, RANK, NEIGHBOURS, FOLDS, ACCEPT = 2000, 48, 25, 5, 0.3
KINDS, HASHED, BINS = 12, 1024, 12
WIDTH = KINDS**3 + HASHED + BINS
_CHUNK = 1 << 20


def _kinds() -> np.ndarray:
    kind = np.full(256, 11, np.uint16)  # every other sign
    for name, code in ((b"\n\r", 1), (b" \t", 0), (b".,;:", 4), (b"'\"()-", 5), (b"!?", 6), (b"|/\\_=+<>[]{}", 7), (b"#$%&*@^~`", 8)):
        kind[list(name)] = code
    kind[ord("a") : ord("z") + 1], kind[ord("A") : ord("Z") + 1], kind[ord("0") : ord("9") + 1], kind[128:] = 2, 3, 9, 10
    return kind


_KIND = _kinds()


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts and the bins of evenness for the texts between the offsets, a row each."""
    n = len(offsets) - 1
    kinds, hashed = np.zeros((n, KINDS**3), np.float32), np.zeros((n, HASHED), np.float32)
    for a in range(0, int(offsets[-1]), _CHUNK):
        b = min(a + _CHUNK, int(offsets[-1]))
        part = data[a : b + 2]
        m = len(part) - 2
        if m <= 0:
            break
        row = np.searchsorted(offsets, np.arange(a, a + m), side="right") - 1 if n < 3 else np.repeat(np.arange(n), np.diff(np.clip(offsets, a, a + m)))
        inside = np.arange(a + 2, a + m + 2) < offsets[row + 1]
        row = row[inside]
        k = _KIND[part]
        code = (k[:-2] * KINDS + k[1:-1]) * KINDS + k[2:]
        kinds += np.bincount(row * KINDS**3 + code[inside], minlength=kinds.size).reshape(kinds.shape)
        w = part.astype(np.uint32)
        code = ((w[:-2] | w[1:-1] << 8 | w[2:] << 16) * np.uint32(2654435761)) >> np.uint32(22)
        hashed += np.bincount(row * HASHED + code[inside], minlength=hashed.size).reshape(hashed.shape)
    total = hashed.sum(axis=1)
    p = hashed / np.maximum(total, 1)[:, None]
    entropy = -(p * np.log(np.where(p > 0, p, 1))).sum(axis=1)
    even = np.where(total > 1, entropy / np.log(np.clip(total, 2, HASHED)), 1)
    bins = np.maximum(0, 1 - np.abs(even[:, None] * (BINS - 1) - np.arange(BINS))) * (total > 0)[:, None]
    return np.hstack([np.log1p(kinds), np.log1p(hashed), bins]).astype(np.float32)


@dataclass
class Model:
    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    vote: np.ndarray  # what one vote of the neighbour counts
    label: np.ndarray
    prior: float

    def place(self, rows: np.ndarray) -> np.ndarray:
        a, b = KINDS**3, KINDS**3 + HASHED
        rows = rows * self.weight
        return unit(np.hstack([unit(rows[:, :a]), 0.5 * unit(rows[:, a:b]), rows[:, b:]]) @ self.basis)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(rows), self.prior)
        near = self.place(rows) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        top = np.argpartition(near, -k, axis=1)[:, -k:]
        votes = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(np.float64) ** 2 * self.vote[top]
        total = votes.sum(axis=1)
        return np.where(total > 0, (votes * self.label[top]).sum(axis=1) / np.where(total > 0, total, 1), self.prior)


def score_texts(model: Model, column: pa.Array) -> np.ndarray:
    data, offsets = flat(column)
    out = np.empty(len(column))
    for i, j in runs(offsets, 256, _CHUNK):
        out[i:j] = model.scores(features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
    return np.clip(out, 0, 1)


def _basis(rows: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors by subspace iteration with a fixed start."""
    rank = min(rank, *rows.shape)
    q = np.linalg.qr(rows.T @ (rows @ np.random.default_rng(0).standard_normal((rows.shape[1], rank + 8)).astype(np.float32)))[0]
    for _ in range(4):
        q = np.linalg.qr(rows.T @ (rows @ q))[0]
    left, _, vt = np.linalg.svd(rows @ q, full_matrices=False)
    return np.ascontiguousarray((q @ vt.T)[:, :rank])


def fit(rows: np.ndarray, label: np.ndarray, counts: dict[int, int]) -> Model:
    """rows: features of the sample; counts: labelled rows of each class."""
    whole = sum(counts.values())
    prior = counts.get(1, 0) / whole if whole else 0.5
    weight, model = np.ones(WIDTH, np.float32), None
    if len(rows):
        weight[:-BINS] = np.log((1 + len(rows)) / (1 + (rows[:, :-BINS] > 0).sum(axis=0))) + 0.1
    model = Model(weight, np.eye(WIDTH, 1, dtype=np.float32), np.empty((0, 1), np.float32), np.empty(0), label.astype(np.float64), prior)
    if len(rows) and 0 < prior < 1:
        model.basis = np.eye(WIDTH, dtype=np.float32)
        model.basis = _basis(model.place(rows), RANK)
        model.vectors = model.place(rows)
        taken = {c: max(1, int((label == c).sum())) for c in (0, 1)}
        model.vote = np.array([counts.get(int(c), 0) / taken[int(c)] for c in label])
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents of each class, outside the held-out fold.

    The sample is the rows of smallest key hash, so it does not depend on the order of rows. Class counts cover all
    labelled rows. Null keys and null marks are left out; of rows that repeat a key one text is taken.
    """
    known = labels.where(F.col(mark).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key, FOLDS, 0)).select(F.col(key).alias("k"), F.col(mark).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    picked = None
    for c in (0, 1):
        own = known.where(F.col("y") == c).distinct().orderBy(F.xxhash64("k"), "k").limit(sample)
        picked = own if picked is None else picked.union(own)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(2))
            for i, j in runs(offsets, 256, _CHUNK):
                f = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], pa.array([r.tobytes() for r in f], pa.binary())], ["k", "y", "f"])

    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    rows = texts.join(F.broadcast(picked), "k").select("k", "y", "t").mapInArrow(each, f"k {kind}, y int, f binary")  # at most 2 x sample keys
    got = sorted((r["k"], r["y"], bytes(r["f"])) for r in rows.groupBy("k", "y").agg(F.min("f").alias("f")).collect())
    matrix = np.frombuffer(b"".join(r[2] for r in got), np.float16).reshape(-1, WIDTH).astype(np.float32)
    return fit(matrix, np.array([r[1] for r in got], int), counts)


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) for every row; no shuffle. Null and empty texts get the class share."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by sample, RANK and WIDTH

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score_texts(shared.value, batch.column(2)))], ["key", "held_out", "score"])

    rows = docs.select(F.col(key).alias("key"), held_out(key, FOLDS, 0).alias("held_out"), F.col(text).alias("text"))
    out = rows.mapInArrow(each, f"key {docs.schema[key].dataType.simpleString()}, held_out boolean, score double")
    return out.select(F.col("key").alias(key), "held_out", "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all rows; an empty table gives an empty result, no labels give 0.5 everywhere."""
    return scored(docs, train(docs, labels, key, text), key, text)


def drop_low(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows that are accepted, with all their columns; decided where the row lies, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, key, text))
    at = docs.columns.index(text)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(score_texts(shared.value, batch.column(at)) >= ACCEPT))

    return docs.mapInArrow(each, docs.schema)
