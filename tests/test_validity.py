"""Validity of polygons: hand-made faults with their reasons, and random rings against all pairs of edges."""

import random

from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators import validity
from test_spatial import box, regular


def raw(spark, rings):
    """Polygons with their rings as given, without turning them."""
    close = lambda r: list(r) + [r[0]]
    rows = [(i, None if rs is None else [[(float(x), float(y)) for x, y in close(r)] for r in rs]) for i, rs in rings.items()]
    frame = spark.createDataFrame(rows, "id long, rings array<array<struct<x:double,y:double>>>")
    shape = F.when(F.col("rings").isNotNull(), shapes.make_shape("polygon", F.col("rings")))
    return shapes.with_bounds(frame.select("id", shape.alias("shape")))


def hole(*args):
    return box(*args)[::-1]


OUTER = box(0, 0, 100, 100)
CASES = {
    1: ([OUTER], None),
    2: ([[(0, 0), (10, 10), (10, 0), (0, 10)]], validity.CROSSING),
    3: ([[(0, 0), (50, 0), (90, 0), (50, 0), (50, 50)]], validity.CROSSING),  # a spike
    4: ([[(0, 0), (10, 0), (5, 5), (10, 10), (0, 10), (5, 5)]], validity.CROSSING),  # touches itself
    5: ([OUTER, hole(20, 20, 30, 30)], None),
    6: ([OUTER, [(0, 50), (30, 60), (30, 40)]], None),  # the hole touches the shell in a point
    7: ([OUTER, hole(0, 20, 30, 30)], validity.CROSSING),  # the hole runs along the shell
    8: ([OUTER, hole(90, 90, 30, 30)], validity.CROSSING),
    9: ([OUTER, hole(200, 20, 30, 30)], validity.OUTSIDE),
    10: ([OUTER, hole(10, 10, 60, 60), hole(20, 20, 5, 5)], validity.OUTSIDE),  # a hole in a hole
    11: ([OUTER, box(20, 20, 30, 30)], validity.NESTED),
    12: ([OUTER, hole(10, 10, 60, 60), box(20, 20, 5, 5)], None),  # an island in the hole
    13: ([OUTER, box(300, 0, 10, 10)], None),
    14: ([[(0, 0), (0, 0), (10, 0), (10, 10), (10, 10)]], None),  # repeated vertices
    15: ([regular(0, 0, 1000, 5000)], None),
    16: (None, None),
    17: ([], None),
}


def test_reasons(spark):
    layer = raw(spark, {k: rings for k, (rings, _) in CASES.items()})
    found = [tuple(r) for r in validity.invalid_polygons(layer).collect()]
    assert sorted(found) == [(k, reason) for k, (_, reason) in CASES.items() if reason]
    good, bad = validity.split_polygons(layer.where("id < 4"))
    assert [r.id for r in good.collect()] == [1] and sorted(r.id for r in bad.collect()) == [2, 3]


def crosses(ring):
    """All pairs of edges; random corners never touch by chance."""
    edges = list(zip(ring, ring[1:] + ring[:1]))
    side = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    return any(
        side(*s, t[0]) * side(*s, t[1]) < 0 and side(*t, s[0]) * side(*t, s[1]) < 0
        for i, s in enumerate(edges)
        for t in edges[i + 2 :]
    )


def test_random_rings_against_all_pairs(spark):
    rnd = random.Random(3)
    rings = {}
    for i in range(300):
        ring = regular(rnd.uniform(0, 900), rnd.uniform(0, 900), rnd.uniform(5, 300), rnd.randint(4, 40), rnd.uniform(0, 6))
        reach = rnd.choice([0.0, 0.3, 3.0, 30.0])
        rings[i] = [[(x + rnd.uniform(-reach, reach), y + rnd.uniform(-reach, reach)) for x, y in ring]]
    found = {r.id for r in validity.crossings(raw(spark, rings)).collect()}
    expected = {i for i, (ring,) in rings.items() if crosses(ring)}
    assert found == expected and 20 < len(expected) < 280
