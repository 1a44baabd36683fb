"""Classifiers by held-out accuracy and by what they promise for odd rows; the forward pass against brute force."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fieldlens.llm import language, quality, toxicity
from fieldlens.llm.catalog import QUERIES
from fieldlens.llm.columnar import flat, pieces, runs, word_spans
from fieldlens.llm.common import read

D = "/root/testdata/sf0.1"
COLUMNS = "doc_id long, text string, lang string, score string, label string"
ODD = [(1, None, "en", "x", None), (2, "", None, "x", None), (None, "some words", "en", "x", None), (3, "12 34 %%", "en", "x", None),
       (4, "la " * 200_000, "fr", "x", None), (5, "wordwithoutend" * 20_000, "en", "x", None), (1, None, "en", "x", None), (6, "É", None, None, None)]


@pytest.mark.parametrize(("name", "mark", "least"), [("op6_quality", "quality", 0.98), ("op10_toxicity", "toxic", 0.93)])
def test_held_out(spark, name, mark, least):
    found = QUERIES[name](spark, D).cache()
    assert found.count() == read(spark, D, "documents").count()
    known = found.join(read(spark, D, "labels"), "doc_id").where("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in known.doc_id) and known.score.between(0, 1).all()
    assert (known.predicted == known[mark]).mean() >= least
    found.unpersist()


def test_language_held_out(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op8_language"](spark, folder).join(read(spark, folder, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(found) == 1000 and all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(found.doc_id, found.held_out))
    held = found[found.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.99


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, COLUMNS)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 0, 0), (3, None, None), (4, 1, 1), (4, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for run in (quality.quality_scores, toxicity.toxicity_scores):
        for known in (labels, none):
            rows = run(docs, known).collect()
            assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
            assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
        assert run(docs.limit(0), labels).count() == 0
    assert quality.drop_low(docs, none).count() == len(ODD) and quality.drop_low(docs, labels).columns == docs.columns
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0
    assert got[4].lang_pred in ("en", "fr") and got[None].held_out is False
    assert language.identify(docs.limit(0)).count() == 0


def brute_forward(model, word):
    text = language._MARK + word
    chance = dict(zip(model.pieces, model.chance))

    def rest(i):
        if i == len(text):
            return np.ones(len(model.langs))
        total = np.zeros(len(model.langs))
        for j in range(i + 1, len(text) + 1):
            part = text[i:j]
            p = chance.get(part)
            if j == i + 1:
                p = np.full(len(model.langs), language.FLOOR) if p is None else np.maximum(p, language.FLOOR)
            if p is not None:
                total = total + p * rest(j)
        return total

    return np.log(rest(0))


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    known = ["▁", "a", "b", "ab", "aba", "▁ab", "ba", "é", "éa", "bb"]
    chance = rng.random((len(known), 2)) / 5
    model = language.Model(["x", "y"], np.zeros(2), known, chance)
    model._prepare()
    words = ["a", "ab", "abab", "xaba", "éaé", "bbbb", "zz"]
    assert np.allclose(model.forward(words), [brute_forward(model, w) for w in words])
    long = "ab" * 100
    parts = model.forward([long, "a"])
    assert np.isfinite(parts).all() and parts[0, 0] < -math.log(2)


def test_flat_columns():
    texts = pa.array(["skip", None, "ab cd", "", "éf", "gh" * 10, "x"]).slice(1)
    data, offsets = flat(texts)
    assert data.tobytes() == "ab cdéf".encode() + b"gh" * 10 + b"x" and len(offsets) == 7
    assert [r for r in runs(offsets, 2, 8)][0] == (0, 2) and sum(j - i for i, j in runs(offsets, 3, 1)) == 6
    letter = np.zeros(256, bool)
    letter[97:123] = letter[128:] = True
    row, start, end = word_spans(data, offsets, letter)
    assert [(int(r), data[a:b].tobytes().decode()) for r, a, b in zip(row, start, end)] == [(1, "ab"), (1, "cd"), (3, "éf"), (4, "gh" * 10), (5, "x")]
    assert sum(len(d) for _, d, _ in pieces(data, offsets, 10, 6, ~letter)) == len(data)


def test_non_negative_risk_learns_from_unlabelled():
    rng = np.random.default_rng(3)
    positive = (rng.random((300, 20)) < np.r_[np.full(5, 0.6), np.full(15, 0.2)]).astype(np.float32)
    clean = (rng.random((1800, 20)) < np.r_[np.full(5, 0.01), np.full(15, 0.2)]).astype(np.float32)
    hidden = (rng.random((200, 20)) < np.r_[np.full(5, 0.6), np.full(15, 0.2)]).astype(np.float32)
    w, bias = toxicity.fit(positive, np.vstack([clean, hidden]), 0.1)
    assert ((hidden @ w + bias) > 0).mean() > 0.85 and ((clean @ w + bias) > 0).mean() < 0.08
