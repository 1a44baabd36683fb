"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; every other text is unlabelled, since some of it is toxic too. A linear
model over hashed words and word beginnings is trained with the class-prior-corrected risk
``prior * R_p+ + max(0, R_u- - prior * R_p-)``: the negative part is estimated from unlabelled text less the share of
positives in it, and may not fall below zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.columnar import Spans, flat, pieces, word_spans
from fieldlens.llm.common import held_out, materialise

POSITIVES, UNLABELLED, TERMS, FOLDS, TOXIC = 2000, 6000, 1024, 5, 0.5
SPACE = 1 << 20
STEPS, RATE, DECAY = 300, 0.05, 1e-4
SURE = 15.0  # evidence (log-likelihood) a term needs, so that chance does not pick terms out of a million
SHARE = 0.3  # of the documents with the term, those estimated toxic: less is a mark of topic or language
_CHUNK = 1 << 20
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = _LETTER[ord("A") : ord("Z") + 1] = _LETTER[128:] = True


def terms(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, term) of the hashed words and their beginnings of four and five bytes; a term may repeat in a row."""
    data, offsets = flat(pc.utf8_lower(column))
    for i, part, at in pieces(data, offsets, 1 << 20, _CHUNK, ~_LETTER):
        row, start, end = word_spans(part, at, _LETTER)
        spans, size = Spans(part), end - start
        for salt, most in ((0, None), (1, 4), (2, 5)):
            on = slice(None) if most is None else size >= most
            s = start[on]
            yield row[on] + i, (spans.of(s, end[on] if most is None else s + most, salt) % np.uint64(SPACE)).astype(np.int64)


@dataclass
class Model:
    weight: np.ndarray  # by term, zero where it has no part
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        found = []
        for row, term in terms(column):
            on = self.weight[term] != 0
            found.append(np.unique(row[on] * SPACE + term[on]))
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        z = self.bias + np.bincount(pairs // SPACE, weights=self.weight[pairs % SPACE], minlength=len(column))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of the non-negative risk with logistic loss, by Adam over whole batches."""
    w, m, v = (np.zeros(positive.shape[1] + 1) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    xp, xu = (np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float32) for x in (positive, unlabelled))
    for step in range(1, STEPS + 1):
        zp, zu = xp @ w.astype(np.float32), xu @ w.astype(np.float32)
        sp, su = 1 / (1 + np.exp(-np.clip(zp, -30, 30))), 1 / (1 + np.exp(-np.clip(zu, -30, 30)))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        down = xu.T @ su / len(xu) - prior * (xp.T @ sp) / len(xp)
        g = prior * (xp.T @ (sp - 1)) / len(xp) + down if negative >= 0 else -down
        g = g + DECAY * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.unique(r * SPACE + t) for r, t in terms(batch.column(1))]
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        cut = np.concatenate(([0], np.cumsum(np.bincount(pairs // SPACE, minlength=batch.num_rows)))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(cut, (pairs % SPACE).astype(np.int32))], ["y", "terms"])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "toxic",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit on at most ``positives`` confirmed toxic and ``unlabelled`` other documents outside the held-out fold.

    Both samples are the rows of smallest key hash. The class prior is the share of toxic rows among all labelled
    rows outside the fold. With no toxic or no unlabelled document every score is the prior.
    """
    free = ~held_out(key, FOLDS, 0) & F.col(key).isNotNull()
    known = labels.where(free & F.col(mark).isin(0, 1)).select(F.col(key).alias("k"), F.col(mark).alias("y"))
    rate = known.agg(F.avg("y")).first()[0]
    prior = min(max(0.01 if rate is None else float(rate), 1e-3), 0.9)
    order = [F.xxhash64("k"), "k"]
    toxic = known.where("y = 1").select("k").distinct()
    chosen = toxic.orderBy(*order).limit(positives).withColumn("y", F.lit(1))
    others = docs.where(free).select(F.col(key).alias("k")).join(toxic, "k", "left_anti").distinct().orderBy(*order).limit(unlabelled)
    picked = materialise(chosen.union(others.withColumn("y", F.lit(0))))
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(picked), "k")  # at most positives + unlabelled keys
    found = materialise(texts.select("y", "t").mapInArrow(_terms_of, "y int, terms array<int>"))
    sizes = {r["y"]: r["count"] for r in found.groupBy("y").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model(np.zeros(SPACE), float(np.log(prior / (1 - prior))))
    seen = found.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("u"))
    usual = (F.col("u") + 0.5) * (sizes[1] / (sizes[0] + 1))  # positives that would have the term if it told nothing
    proof = F.when(F.col("p") > usual, F.col("p") * F.log(F.col("p") / usual) - F.col("p") + usual)
    best = [r["term"] for r in seen.withColumns({"proof": proof, "usual": usual}).where((F.col("proof") >= SURE) & (prior * F.col("p") >= SHARE * F.col("usual"))).orderBy(F.desc("proof"), "term").limit(TERMS).collect()]
    at = np.full(SPACE, -1, np.int32)
    at[best] = np.arange(len(best))

    def chosen_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lists in batch.column(1):
                bits = np.zeros(TERMS, np.uint8)
                on = at[np.asarray(lists.values)]
                bits[on[on >= 0]] = 1
                rows.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["y", "bits"])

    got = found.mapInArrow(chosen_terms, "y int, bits binary").groupBy("y", "bits").count().collect()  # rows: at most the sample
    sides = []
    for y in (1, 0):
        own = sorted((bytes(r["bits"]), r["count"]) for r in got if r["y"] == y)
        bits = np.unpackbits(np.frombuffer(b"".join(b for b, _ in own), np.uint8).reshape(-1, TERMS // 8), axis=1)
        sides.append(np.repeat(bits, [min(c, positives + unlabelled) for _, c in own], axis=0)[:, : len(best)].astype(np.float32))
    w, bias = fit(sides[0], sides[1], prior)
    weight = np.zeros(SPACE)
    weight[best] = w
    return Model(weight, bias)


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) for every row, null and empty texts too (the score of a text without words)."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, key, text))  # SPACE weights

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.scores(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["key", "held_out", "score"])

    rows = docs.select(F.col(key).alias("key"), held_out(key, FOLDS, 0).alias("held_out"), F.col(text).alias("text"))
    out = rows.mapInArrow(each, f"key {docs.schema[key].dataType.simpleString()}, held_out boolean, score double")
    return out.select(F.col("key").alias(key), "held_out", "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
