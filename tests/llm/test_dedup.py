"""Exact and SimHash duplicates against brute force on small frames and on the driver's table."""

import hashlib
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm import exact_dedup, simhash
from fieldlens.llm.common import read
from fieldlens.llm.graph import components

D = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("row_hash", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)


def brute_exact(rows):
    groups = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, n))
    out = []
    for bare, own in groups.items():
        best = min(own)
        for _, null, i, _n in own:
            out.append((None if null else i, None if best[1] else best[2], len(own), hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


LONG = "äbc " * 9000
ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (3, "a  b"), (4, None), (5, ""), (6, " \n"), (None, "ab"), (None, None), (7, LONG), (8, LONG + " "),
        (9, LONG + "x"), (10, "x" + LONG), (11, "ab" * 4096), (12, "ab" * 4096 + "c"), (13, "ab" * 8192), (7, "other"), (14, " a b")]


@pytest.mark.parametrize("block", [8, 1000, 8192])
@pytest.mark.parametrize("weak", [False, True])
def test_exact(spark, block, weak):
    if block == 8 and weak:
        pytest.skip("one hash for thousands of blocks")
    hashed = (lambda b: F.octet_length(b).cast("long")) if weak else F.xxhash64
    rows = [(i, t if t is None or block > 8 else t[:300]) for i, t in ROWS]
    got = exact_dedup.exact_groups(frame(spark, rows), block=block, hashed=hashed).collect()
    want, groups = brute_exact(rows)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == want
    assert sum(r.kept for r in got) == groups


def test_exact_empty_and_rows(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0
    kept = exact_dedup.drop_exact(frame(spark, ROWS))
    assert kept.columns == SCHEMA.names and kept.count() == brute_exact(ROWS)[1]
    assert exact_dedup.drop_exact(frame(spark, [])).count() == 0


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = max(1, len(words) - 3)
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def brute_groups(ids, prints, bits=4):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i in range(len(ids)):
        if ids[i] is not None:
            least[root(i)].append(ids[i])
    return [min(least[root(i)], default=None) for i in range(len(ids))]


def test_simhash_whole_table(spark):
    docs = read(spark, D, "documents").select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in docs]
    want = {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(docs, prints, brute_groups([r.doc_id for r in docs], prints))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_groups(read(spark, D, "documents")).collect()}
    assert got == want


def test_simhash_edges(spark):
    rows = [(5, None), (None, ""), (3, "One two"), (2, "one \t two"), (9, "a b c d e"), (9, "a b c d e"), (None, "lonely words here now then"), (4, "É é x y z")]
    got = simhash.near_groups(frame(spark, rows)).collect()
    prints = [brute_print(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], [f"{p:016x}" for p in prints], brute_groups([i for i, _ in rows], prints)), key=str)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=str) == want
    kept = simhash.drop_near(frame(spark, rows))
    assert sorted(kept.collect(), key=str) and kept.count() == len({r.component for r in got}) and kept.columns == SCHEMA.names
    assert simhash.near_groups(frame(spark, [])).count() == 0


def test_forest_of_dense_and_sparse_prints(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fp = np.unique(np.concatenate([b ^ sum(np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64) for _ in range(4)) for b in base]))
    a, b = simhash._forest(fp, fp[:32], 4)
    groups = brute_groups(list(range(len(fp))), [int(x) for x in fp])
    edges = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long")
    label = {r.node: r.label for r in components(edges).collect()}
    assert [label.get(i, i) for i in range(len(fp))] == groups
    assert len(simhash.tables(10**6, 4)) == 15 and len(simhash.tables(10, 4)) == 5


def test_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "a long, b long")
    label = {r.node: r.label for r in components(edges).collect()}
    assert all(label[i] == 0 for i in range(301)) and label[1001] == 1000
