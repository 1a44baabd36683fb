"""The exact spatial test by joins of segments: against plain loops, against the test inside rows, and on large shapes."""

import random
import time

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators import grid, meeting
from test_spatial import box, polygons, regular


def side(a, b, p):
    return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])


def cross(s, t):
    return side(*s, t[0]) * side(*s, t[1]) < 0 and side(*t, s[0]) * side(*t, s[1]) < 0


def edges(rings):
    return [e for r in rings for e in zip(r, r[1:] + r[:1])]


def inside(p, rings):
    """Even-odd rule along a ray to the right."""
    return sum((a[1] <= p[1]) != (b[1] <= p[1]) and side(a, b, p) * (b[1] - a[1]) > 0 for a, b in edges(rings)) % 2 == 1


def meet(a, b):
    return any(cross(s, t) for s in edges(a) for t in edges(b)) or any(inside(r[0], b) for r in a) or any(inside(r[0], a) for r in b)


def ragged(rnd, n, reach):
    ring = regular(rnd.uniform(0, 2000), rnd.uniform(0, 2000), rnd.uniform(20, 500), n, rnd.uniform(0, 6))
    return [(x + rnd.uniform(-reach, reach), y + rnd.uniform(-reach, reach)) for x, y in ring]


@pytest.fixture(scope="module")
def random_rings():
    rnd = random.Random(11)
    make = lambda n: {i: [ragged(rnd, rnd.choice([4, 9, 30, 80]), 2.0)] for i in range(n)}
    a, b = make(50), make(40)
    for i in range(50, 60):  # rings with a hole, some of them around a right shape
        x, y = rnd.uniform(0, 1500), rnd.uniform(0, 1500)
        a[i] = [box(x, y, 500, 500), regular(x + 250, y + 250, 240, 60)]
        b[i] = [regular(x + 250, y + 250, rnd.choice([100, 239, 242]), 70, 0.03)]
    a[60] = [regular(9000, 9000, 50, 100)]  # alone
    return a, b


def found(frame):
    return sorted((r[0], r[1]) for r in frame.select("l.id", F.col("r.id").alias("other")).collect())


def test_both_ways_against_loops(spark, random_rings):
    a, b = random_rings
    want = sorted((i, j) for i in a for j in b if meet(a[i], b[j]))
    la, lb = polygons(spark, a), polygons(spark, b)
    assert 200 < len(want) < len(a) * len(b) - 200
    for direct in (0, 400, grid.DIRECT):
        assert found(grid.meet_pairs(la, lb, direct=direct)) == want
        keys = sorted(r.id for r in grid.matched_keys(la, lb, direct=direct).collect())
        assert keys == sorted({i for i, _ in want})
    some = [i for i in a if i % 6 == 0]
    assert found(grid.meet_pairs(la.where("id % 6 = 0"), lb, direct=10**12)) == [(i, j) for i, j in want if i in some]
    odd = grid.meet_pairs(la, lb, (F.col("l.id") + F.col("r.id")) % 2 == 1, direct=0)
    assert found(odd) == [(i, j) for i, j in want if (i + j) % 2 == 1]


def test_left_join_keeps_every_row_once(spark, random_rings):
    a, b = random_rings
    la, lb = polygons(spark, a), polygons(spark, b)
    want = sorted([(i, j) for i in a for j in b if meet(a[i], b[j])] + [(i, -1) for i in a if not any(meet(a[i], s) for s in b.values())])
    out = grid.spatial_join(la, lb, "left").select("id_left", F.coalesce("id_right", F.lit(-1)).alias("other"), "x0_left")
    rows = out.collect()
    assert sorted((r[0], r[1]) for r in rows) == want and all(r.x0_left is not None for r in rows)
    assert any(j == -1 for _, j in want)


def test_points_lines_touching_and_odd_rows(spark):
    ring = regular(0, 0, 100, 200)
    layer = polygons(spark, {1: [ring], 2: [box(1000, 0, 10, 10)], 3: [box(100, -5, 10, 10)]})
    p = shapes.point
    lit = lambda *vs: F.array(*[p(F.lit(float(x)), F.lit(float(y))) for x, y in vs])
    others = {
        10: shapes.point_shape(F.lit(0.0), F.lit(0.0)), 11: shapes.point_shape(F.lit(100.0), F.lit(0.0)),
        12: shapes.line_shape(lit((-500, 1), (500, 1))), 13: shapes.line_shape(lit((-5, 1), (5, 1))),
        14: shapes.line_shape(lit((0, 101), (50, 101))), 15: shapes.line_shape(lit((100, -50), (100, 50))),
        16: F.lit(None).cast(layer.schema["shape"].dataType),
        17: shapes.make_shape("line", lit().cast("array<struct<x:double,y:double>>") if False else F.array().cast("array<array<struct<x:double,y:double>>>")),
    }
    right = None
    for i, shape in others.items():
        row = spark.range(1).select(F.lit(i).cast("long").alias("id"), shape.alias("shape"))
        right = row if right is None else right.unionByName(row)
    right = shapes.with_bounds(right)
    want = [(1, 10), (1, 11), (1, 12), (1, 13), (1, 15), (3, 11), (3, 12), (3, 15)]
    for direct in (0, 10**12):
        assert found(grid.meet_pairs(layer, right, direct=direct)) == want
        assert sorted(r.id for r in grid.matched_keys(layer, right, direct=direct).collect()) == [1, 3]
    empty = right.where("false")
    assert grid.meet_pairs(layer, empty, direct=0).count() == 0 and grid.matched_keys(empty, layer, direct=0).count() == 0


def test_large_shapes(spark):
    """Rings of 10,000 vertices: inside each other without touching, crossing, beside each other, and 500 copies of one."""
    n = 10_000
    outer = polygons(spark, {1: [regular(0, 0, 1000, n)], 2: [regular(5000, 0, 1000, n)], 3: [regular(9000, 0, 1000, n)]})
    inner = polygons(spark, {1: [regular(0, 0, 999, n)], 2: [regular(5000.5, 0, 1000, n)], 3: [regular(11000.1, 0, 1000, n)]})
    inner = inner.unionByName(inner.where("id = 2").drop("id").crossJoin(spark.range(100, 600)).select("id", "shape", "x0", "y0", "x1", "y1"))
    assert found(grid.meet_pairs(outer, inner.where("id < 4"))) == [(1, 1), (2, 2)]
    start = time.time()
    pairs = found(grid.meet_pairs(outer, inner))
    assert pairs == [(1, 1), (2, 2)] + [(2, i) for i in range(100, 600)]
    assert time.time() - start < 60


def test_only_rings_inside_the_others_box_are_looked_up(spark, monkeypatch):
    """Of two large rings that cross or lie apart none can hold the other: no edge is searched for them."""
    outer = polygons(spark, {1: [regular(0, 0, 100, 90)]})
    others = polygons(spark, {1: [regular(0, 0, 50, 90)], 2: [regular(95, 0, 30, 90)], 3: [regular(95, 95, 30, 90)]})
    seen = []
    strip = meeting._strip
    monkeypatch.setattr(meeting, "_strip", lambda rows, *a: seen.append(rows) or strip(rows, *a))
    assert found(grid.meet_pairs(outer, others, direct=0)) == [(1, 1), (1, 2)]
    assert seen[0].count() == 1
