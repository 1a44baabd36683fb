"""Decontamination, mixture, line chunks and the pipeline against brute force."""

import random
from collections import Counter, defaultdict

import pyarrow as pa

import corpus_pipeline
from fieldlens.llm import decontaminate, exact_dedup, linededup, mixing, quality, simhash
from fieldlens.llm.common import read

D = "/root/testdata/sf0.001"


def best_fit(item: bytes, text: bytes) -> int:
    """Edit distance of the item to the best stretch of the text."""
    now = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(now[j - 1] + (c != x), now[j] + 1, new[j - 1] + 1))
        now = new
    return min(now)


def edited(text: str, edits: int, rng) -> str:
    text = list(text)
    for _ in range(edits):
        i, kind = rng.randrange(len(text)), rng.randrange(3)
        text[i : i + (kind != 2)] = [] if kind == 1 else [rng.choice("abcxyz")]
    return "".join(text)


def test_contaminated(spark):
    rng = random.Random(2)
    items = [(r.item_id, r.text) for r in read(spark, D, "benchmark").limit(12).collect()]
    base = [r.text[:600] for r in read(spark, "/root/testdata/sf0.01", "documents").where("length(text) > 700").limit(60).collect()]
    rows, planted = [], set()
    for n, text in enumerate(base):
        if n < 45:
            item, passage = items[n % len(items)]
            rate = (0, 0.02, 0.05)[n % 3]
            text = text[:200] + " " + edited(passage, int(rate * len(passage)), rng).upper() * (n % 5 == 0) + text[200:] if n % 5 == 0 else text[:200] + "\n" + edited(passage, int(rate * len(passage)), rng) + " " + text[200:]
            planted.add((n, item))
        rows.append((n, text, "x"))
    rows += [(None, items[0][1], "x"), (100, None, "x"), (101, "", "x"), (102, "x" * 100_000, "x"), (0, rows[0][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item string")
    bench = spark.createDataFrame([*items, (500, None), (501, "short"), (502, items[1][1])], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.contaminated(docs, bench).collect()}
    assert (None, items[0][0]) in got and {i for _, i in got} <= {i for i, _ in items} | {502}
    held = {(n, i) for n, i in planted if best_fit(decontaminate.normal(dict(items)[i]), decontaminate.normal(rows[n][1])) <= 0.1 * len(decontaminate.normal(dict(items)[i]))}
    for (n, i), far in got.items():
        if n is not None and i != 502:
            passage = decontaminate.normal(dict(items)[i])
            assert far == best_fit(passage, decontaminate.normal(rows[n][1])) <= 0.1 * len(passage)
    assert len(held) > 30 and len(held & set(got)) >= 0.95 * len(held)
    kept = decontaminate.drop_contaminated(docs, bench)
    left = {r.doc_id for r in kept.collect()}
    assert {100, 101, 102} <= left and None not in left and not {n for n, i in got if n is not None} & left and kept.columns == docs.columns
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0 and decontaminate.contaminated(docs.limit(0), bench).count() == 0
    sliced = {(r.doc_id, r.item_id): r.distance for r in decontaminate.contaminated(docs, bench, slice_bytes=700).collect()}
    assert sliced == got


def test_long_text_in_parts():
    item = "the quick brown fox jumps over the lazy dog and runs away from it"
    index = decontaminate.Index(decontaminate.passages([(1, item)]))
    for at in (0, decontaminate._CHUNK - 20, decontaminate._CHUNK + 5, 9_000_000):
        text = "x y " * (at // 4) + item + " z" * 200_000
        assert [(r, i) for r, i, _ in decontaminate.found_in(index, pa.array(["", text]))] and set(decontaminate.found_in(index, pa.array([text]))) == {(0, 1, 0)}


def test_mixture(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(1, 30), "big", 0) for i in range(2000)] + [(3000 + i, "w " * 10, "mid", 0) for i in range(200)] + [(4000 + i, "w x", None, 0) for i in range(20)]
    rows += [(5000, None, "mid", 0), (5001, "", "empty", 0), (None, "a b c", "mid", 0), (1, rows[1][1], "big", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, block long").drop("block")
    got = mixing.mixture(docs, block=500, repeats=4.0, entropy=0.9).collect()
    tokens, whole, used = Counter(), Counter(), defaultdict(int)
    for i, t, s, _ in rows:
        whole[s] += len((t or "").split())
    for r in got:
        tokens[r.source] += r.n_tokens
        used[r.source, r.doc_id, r["pass"]] += 1
    budgets = {r.source: r.budget for r in got}
    assert set(budgets) == {"big", "mid", None} and abs(sum(budgets.values()) - sum(whole.values())) <= 3
    for s, budget in budgets.items():
        assert budget <= tokens[s] < budget + 60 and tokens[s] / whole[s] < 4.5
    assert max(r["pass"] for r in got if r.source is None) == 3  # the limit of repetition binds for the rarest source
    assert all(n == (2 if d == 1 else 1) for (_, d, _), n in used.items())
    twice = mixing.mixture(docs, block=500, repeats=4.0, entropy=0.9).collect()
    assert Counter(twice) == Counter(got)
    assert mixing.mixture(docs.limit(0)).count() == 0
    assert mixing.mixture(docs.where("source = 'empty'")).count() == 0


def test_line_chunks(spark):
    rng = random.Random(7)
    shared = [f"shared line {i} {rng.random()}" for i in range(30)]
    texts = ["\n".join([f"own {n} {i} {rng.random()}" for i in range(rng.randrange(8))] + shared + [f"end {n}"]) for n in range(6)]
    rows = [(n, t, 1) for n, t in enumerate(texts)] + [(50, None, 1), (51, "", 1), (52, "\n\n\n", 1), (None, texts[2], 1), (3, texts[3], 1), (53, "a\r\nb", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines long")
    seen, want = set(), Counter()
    for i, t, _ in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        lines, begin, end = linededup.chunks(t or "")
        kept = []
        for a, b in zip(begin, end):
            body = "\n".join(lines[a:b])
            if b - a >= 2 and body in seen:
                continue
            seen.add(body)
            kept += lines[a:b]
        want[i, "\n".join(kept) if t is not None else None, len(lines), len(lines) - len(kept)] += rows.count((i, t, 1))
    out = linededup.dedupe_lines(docs)
    assert out.columns == ["doc_id", "text", "n_lines", "n_lines_", "n_removed"]
    got = Counter((r.doc_id, r.text, r["n_lines_"], r.n_removed) for r in out.collect())
    assert {k for k in want if k[0] != 52} <= set(got) and sum(got.values()) == len(rows)
    assert sum(r.n_removed for r in out.where("doc_id in (1, 2, 4, 5)").collect()) > 60
    assert linededup.dedupe_lines(docs.limit(0)).count() == 0


def test_pipeline_against_its_parts(spark):
    docs = read(spark, D, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    judged = {r.doc_id for r in quality.quality_scores(docs, read(spark, D, "labels")).where("predicted = 1").collect()}
    first = {}
    for i in sorted(judged, key=lambda i: (-len(rows[i].text), i)):
        first.setdefault("".join(rows[i].text.split(" ")).translate({c: None for c in range(9, 14)}), i)
    prints = {i: simhash.fingerprint(rows[i].text.encode()) for i in first.values()}
    left, near = set(prints), set()
    for i in sorted(prints):
        if i in left:
            reach = [i]
            near.add(i)
            while reach:
                x = reach.pop()
                left.discard(x)
                own = {j for j in left if (prints[j] ^ prints[x]).bit_count() <= 4}
                left -= own
                reach += own
    items = [decontaminate.normal(r.text) for r in read(spark, D, "benchmark").collect()]
    clean = {i for i in near if not any(p in decontaminate.normal(rows[i].text) for p in items)}
    out = corpus_pipeline.run(spark, D)
    assert {r.doc_id for r in out.select("doc_id").collect()} <= clean
    kept = exact_dedup.drop_exact(docs).count()
    assert 0 < kept <= len(rows) and len(corpus_pipeline.STAGES) == 5 and set(docs.columns) <= set(out.columns)
