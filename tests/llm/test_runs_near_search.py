"""Periodic runs, MinHash groups and ranked search against brute force, with odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm import lexical, minhash, periodic

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *[T.StructField(c, T.StringType()) for c in ("key", "runs", "n", "score", "node", "item")]])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 6) for i, t in rows], SCHEMA)


def brute_runs(words, least=24, times=3):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in found.items())


def periodic_text(rng, n, kinds):
    words = [rng.choice("abcdefgh"[:kinds]) + rng.choice(["", "x"]) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        a, p, m = rng.randrange(n), rng.randint(1, 40), rng.randint(1, 150)
        for i in range(a + p, min(n, a + m)):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("least,times", [(24, 3), (4, 3), (10, 5)])
def test_runs_of_random_words(least, times):
    rng = random.Random(least)
    for _ in range(400):
        words = periodic_text(rng, rng.randint(1, 250), rng.randint(1, 8))
        coded = np.unique(words, return_inverse=True)[1].astype(np.int64)
        got = [(a + s, n, q) for a, b in periodic.segments(coded, np.array([0, len(coded)]), least, times) for s, n, q in periodic.runs_of(coded[a:b], least, times)]
        assert sorted(got) == brute_runs(words, least, times)


def test_runs_do_not_cross_documents_and_odd_rows(spark):
    rng = random.Random(7)
    rows = [(1, "a " * 12), (2, "a " * 12), (3, None), (4, ""), (5, " \n\t"), (None, "b " * 30), (6, "Ä é x " * 9), (6, "Ä é x " * 9)]
    rows += [(10 + k, " \t".join(periodic_text(rng, 200, 1 + k % 8))) for k in range(40)]
    rows += [(100, " ".join(f"w{k}" for k in range(60_000)) + " p q r" * 40_000)]
    got = periodic.find_runs(frame(spark, rows)).collect()
    want = []
    for i, t in rows:
        words = WORDS.findall(t or "")
        found = [(60_000, 120_000, 3)] if i == 100 else brute_runs(words)
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        want.append((str(i), len(words), found, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == sorted(want)
    assert periodic.find_runs(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(frame(spark, []), times=2)


def test_strongest_run_is_exact(spark):
    runs = [(5, 30, 7), (0, 60, 14), (90, 3 * 10**9, 7 * 10**8), (400, 24, 1), (500, 24, 1)]
    row = spark.createDataFrame([(runs,), ([],)], f"runs array<{periodic.RUN}>").select(periodic.strongest(F.col("runs")).alias("b"), periodic.run_digest(F.col("runs")).alias("d")).collect()
    assert tuple(row[0].b) == (400, 24, 1) and row[1].b is None and len(row[1].d) == 64


def brute_sets(text, k=3):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}


def brute_near(rows, percent=85):
    sets = [brute_sets(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for n, (i, _) in enumerate(rows):
        least.setdefault(root(n), []).append((i is None, i))
    return sorted(((i, len(sets[n]), min(least[root(n)], key=lambda x: (x[0], x[1] or 0))[1]) for n, (i, _) in enumerate(rows)), key=str)


def near_rows():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = [(1, "a b c"), (2, "A  b C"), (3, "a b"), (4, "a"), (5, None), (6, ""), (6, ""), (7, " "), (None, "a b c"), (None, "n u l l"), (8, "ab"), (9, "a B"), (3, "other words here again")]
    for g in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([60, 300, 900]))]
        now = list(base)
        for k in range(25):  # chains: each member is near the one before, not the first; some at the limit
            rows.append((100 * g + 20 + k, " ".join(now)))
            for _ in range(max(1, int(len(now) * rng.choice([0.005, 0.02, 0.027, 0.04])))):
                now[rng.randrange(len(now))] = rng.choice(vocabulary)
    return rows


def test_near_groups_against_brute_force(spark):
    rows = near_rows()
    got = minhash.near_groups(frame(spark, rows).repartition(5)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_near(rows)
    assert minhash.near_groups(frame(spark, [])).count() == 0


def test_dense_family_below_the_threshold_is_gone_through_whole(spark, monkeypatch):
    """Members that are alike without links, dealt over several blocks, with a few links planted among them."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(1000)]
    base = [rng.choice(vocabulary) for _ in range(300)]
    rows = []
    for k in range(120):
        own = list(base)
        for _ in range(9):
            own[rng.randrange(300)] = rng.choice(vocabulary)
        rows.append((k, " ".join(own)))
        if k % 10 == 0:
            own[rng.randrange(300)] = "planted"
            rows.append((1000 + k, " ".join(own)))
    got = minhash.near_groups(frame(spark, rows)).collect()
    want = brute_near(rows)
    assert len({c for _, _, c in want}) > 20
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want


def test_keys_meet_all_pairs_within_the_distance():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << minhash.BITS, (300, minhash.SYMBOLS)).astype(np.uint16)
    two = one.copy()
    for r in range(300):
        spots = rng.permutation(minhash.SYMBOLS)[: 2 * minhash.CHUNKS - 1]
        two[r, spots] ^= 1
    assert (minhash.keys(one) == minhash.keys(two)).any(axis=1).all()
    assert len(np.unique(minhash.keys(one))) == 300 * minhash.SYMBOLS  # the key holds chunk, hole and symbols


def test_long_text_signature_equals_whole():
    own = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 100_000, dtype=np.uint64))
    whole = [(((own * minhash._SEEDS[0, s] + minhash._SEEDS[1, s]).min() >> np.uint64(20)) & np.uint64(1023)) for s in range(minhash.SYMBOLS)]
    small = np.array([7], np.uint64)
    got = minhash.signatures([small, own, np.empty(0, np.uint64), small])
    assert got[1].tolist() == [int(x) for x in whole] and (got[0] == got[3]).all()


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, top=10):
    split = lambda t: TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    own = [(i, Counter(split(t)), len(split(t))) for i, t in docs]
    n, total = sum(x > 0 for _, _, x in own), sum(x for _, _, x in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, t in items:
        asked, scored = Counter(split(t)), []
        for i, c, size in own:
            m = 25 + 75 * size * n // total if size else 0
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w, q in asked.items() if w in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def search_rows():
    rng = random.Random(11)
    vocabulary = [f"{w}{k}" for k in range(60) for w in ("ab", "Äé", "x")] + ["the", "Of"]
    pick = lambda n: " ".join(rng.choice(vocabulary[int(len(vocabulary) * rng.random() ** 2) :]) for _ in range(n))
    docs = [(k, pick(rng.choice([3, 8, 8, 8, 40, 300]))) for k in range(400)] + [(k, "same ab1 text") for k in range(500, 560)]
    docs += [(None, "ab1 ab2 the"), (None, None), (900, None), (901, ""), (902, "--- !"), (903, pick(50_000)), (3, "ab1"), (904, "the_the-THE.the")]
    items = [(k, pick(rng.choice([1, 5, 30]))) for k in range(40)] + [(100, None), (101, ""), (102, "zzz"), (5, "ab1 ab1 the"), (None, "same"), (103, "the Of the " * 30)]
    return docs, items


@pytest.mark.parametrize("slice_items,part", [(2000, 8 << 20), (7, 2000)])
def test_search_against_brute_force(spark, monkeypatch, slice_items, part):
    monkeypatch.setattr(lexical, "SLICE_ITEMS", slice_items)
    docs, items = search_rows()
    asked = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical.search(frame(spark, docs).repartition(6), asked).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str) == brute_search(docs, items)


def test_search_of_empty_tables_and_text_keys(spark):
    docs, items = search_rows()
    none = spark.createDataFrame([], "item_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert lexical.search(frame(spark, docs), none).count() == 0 and lexical.search(frame(spark, []), asked).count() == 0
    named = spark.createDataFrame([(f"d{k}", t) for k, t in docs[:100]], "name string, body string")
    got = lexical.search(named, asked, key="name", text="body").collect()
    want = brute_search([(f"d{k}", t) for k, t in docs[:100]], items)
    assert sorted((r.item_id, r["rank"], r.score) for r in got if r.item_id is not None) == sorted((a, b, d) for a, b, _, d in want if a is not None)


def test_wide_sums_stay_exact():
    q = lexical.Queries.of(["a " * 3, "b"])
    q.weight = np.array([1, 1])
    cells, values = np.array([0, 0, 1]), np.array([1 << 53, 1, 5])
    q.wide = True
    assert q.add(cells, values, 2).tolist() == [(1 << 53) + 1, 5]
