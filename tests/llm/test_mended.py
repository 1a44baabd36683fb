"""Rows that differ in the place of a null, clashing columns, ties at a budget, long words, glued passages, plain sums."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from fieldlens.llm import decontaminate, exact_dedup, language, linededup, mixing, simhash
from fieldlens.llm.common import read

D = "/root/testdata/sf0.01"


def test_nulls_in_different_columns_are_different_rows(spark):
    rows = [(1, None, "same words here"), (1, "same words here", None), (1, "same words here", "same words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string")
    kept = {tuple(r) for r in exact_dedup.drop_exact(docs).collect()}
    assert rows[0] in kept and len(kept) == 2
    near = {tuple(r) for r in simhash.drop_near(docs).collect()}
    assert rows[0] in near and len(near) == 2
    bench = spark.createDataFrame([(7, "some words of a benchmark item that is long enough to be looked for")], "item_id long, text string")
    bad = (2, "x " + bench.first().text, None)
    good = (2, None, bad[1])
    mixed = spark.createDataFrame([bad, good], "doc_id long, text string, note string")
    assert [tuple(r) for r in decontaminate.drop_contaminated(mixed, bench).collect()] == [good]
    assert linededup.dedupe_lines(docs).count() == 3


def test_maps_inside_structs_can_be_hashed(spark):
    docs = spark.sql("select 1L doc_id, 'a b' text, named_struct('m', map('k', 1)) s, array(map('k', 2)) t union all select 1L, 'a  b', named_struct('m', map('k', 3)), null")
    assert exact_dedup.drop_exact(docs).count() == 1


CLASH = ["pass", "n_tokens", "budget", "source_key", "block", "rank", "row", "spot", "size", "last"]


def test_mixture_keeps_clashing_columns(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2], *[i] * len(CLASH)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} long" for c in CLASH))
    out = mixing.mixture(docs, carry=tuple(docs.columns), block=50)
    assert out.columns == [*["doc_id", "source"], "text", *CLASH, "n_tokens_", "pass_", "block_", "start_tokens", "budget_"]
    got = out.collect()
    assert got and all(r[c] == r.doc_id for r in got for c in CLASH)
    plain = mixing.mixture(docs.select("doc_id", "text", "source"), block=50).collect()
    assert Counter((r.doc_id, r["pass"], r.block) for r in plain) == Counter((r.doc_id, r["pass_"], r["block_"]) for r in got)


@pytest.mark.parametrize("key", [1, None])
def test_ties_end_at_the_budget(spark, key):
    docs = spark.createDataFrame([(key, "w " * 11 + f"x{i}", "one") for i in range(50)] + [(i + 2, "w", "two") for i in range(30)], "doc_id long, text string, source string")
    out = mixing.mixture(docs, budget=400, block=100_000).collect()
    for source, tokens in (("one", 12), ("two", 1)):
        used, budget = sum(r.n_tokens for r in out if r.source == source), next(r.budget for r in out if r.source == source)
        assert budget <= used < budget + tokens


def test_forward_sums_all_cuts_of_long_words():
    rng = random.Random(1)
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "abc", "c", "é", "éa"]
    model = language.Model(["x", "y"], np.zeros(2), pieces, np.array([[rng.random() / 10 for _ in range(2)] for _ in pieces]))
    model._prepare()
    words = ["".join(rng.choice("abcéz") for _ in range(n)) for n in (1, 2, 7, 44, 46, 49, 200, 2000)]

    def plain(word, k):
        text, chance = "▁" + word, {p: model.chance[i][k] for i, p in enumerate(pieces)}
        logs = [0.0]
        for end in range(1, len(text) + 1):
            terms = []
            for begin in range(max(0, end - 4), end):
                part = text[begin:end]
                value = max(chance.get(part, 0), language.FLOOR) if len(part) == 1 else chance.get(part)
                if value:
                    terms.append(logs[begin] + math.log(value))
            most = max(terms)
            logs.append(most + math.log(sum(math.exp(t - most) for t in terms)))
        return logs[-1]

    got = model.forward(words)
    assert np.allclose(got, [[plain(w, 0), plain(w, 1)] for w in words], rtol=1e-12)
    # whole predictions: words, priors and Bayes' rule by plain loops, a word without a blank in a text of many parts
    model.prior = np.log([0.3, 0.7])
    texts = ["ab abc, ba!", None, "12 34", "a" * 300, "abc " * 50, "b\tc\nab"]
    langs, score = model.predict(pa.array(texts, pa.string()))
    for t, lang, s in zip(texts, langs, score):
        own = [w for w in (language.letters(w) for w in (t or "").lower().split()) if w]
        if not own:
            assert (lang, s) == (language.UNKNOWN, 0.0)
            continue
        logs = [math.log(p) + sum(plain(w, k) for w in own) for k, p in enumerate((0.3, 0.7))]
        assert lang == "xy"[logs[1] > logs[0]] and s == pytest.approx(1 / sum(math.exp(x - max(logs)) for x in logs))


def test_a_word_is_never_cut(monkeypatch):
    monkeypatch.setattr(language, "_SLICE", 64)
    text = "ab " * 30 + "c" * 500 + " de" * 40
    parts = [t.as_py() for _, x in language._slices(pa.array([text, "x", None])) for t in x]
    assert "".join(parts[:-2]) == text and any("c" * 500 in p for p in parts)


def edited(rng, data, n):
    out = list(data)
    for _ in range(n):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdefgh")
        elif kind == 1:
            out.insert(at, rng.choice("abcdefgh"))
        else:
            del out[at]
    return "".join(out)


@pytest.mark.parametrize("before", [" ", "glued", "x"])
def test_recall_at_the_edit_limit(spark, before):
    """Items with a tenth of their length in edits, after a blank or inside a word; of single bytes, so that edits are byte edits."""
    rng = random.Random(len(before))
    items = [(r.item_id, decontaminate.normal(r.text).decode()) for r in read(spark, D, "benchmark").collect()]
    index = decontaminate.Index(decontaminate.passages(items))
    texts = [r.text for r in read(spark, D, "documents").where("n_chars between 500 and 3000").limit(60).collect()]
    hit = tried = 0
    for item, data in [(i, d) for i, d in items if d.isascii()]:
        for _ in range(20):
            body, host = edited(rng, data, int(decontaminate.RATE * len(data))), rng.choice(texts)
            tried += 1
            hit += any(i == item for _, i, _ in decontaminate.found_in(index, pa.array([host[:300] + before + body + before + host[300:]])))
    assert tried >= 150 and hit / tried >= 0.95, hit / tried


def test_pipeline_equals_its_parts_with_odd_rows(spark, tmp_path):
    docs = read(spark, D, "documents")
    odd = spark.createDataFrame(
        [(90_001, None, "en", "web", 0), (90_002, "", "en", "web", 0), (None, "an own text of some words without a key", "en", None, 39), (5, "the key of another row, with other words in it", None, "web", 46)]
        + [(90_003, "a very long text of many words " * 20_000, "en", "web", 620_000)] * 2,
        docs.schema,
    )
    for name in ("labels", "benchmark"):
        read(spark, D, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs.unionByName(odd).write.parquet(str(tmp_path / "documents.parquet"))
    here = str(tmp_path)
    now = read(spark, here, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, now, here).select(*docs.columns)
        before = Counter(map(tuple, now.collect()))
        after = Counter(map(tuple, kept.collect()))
        assert after and not after - before
        now = spark.createDataFrame(list(after.elements()), docs.schema)
    want = Counter((r.doc_id, r.text, r["pass"]) for r in mixing.mixture(now, carry=tuple(docs.columns)).collect())
    out = corpus_pipeline.run(spark, here)
    assert Counter((r.doc_id, r.text, r["pass"]) for r in out.collect()) == want
