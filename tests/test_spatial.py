"""Spatial operators against brute force and against their own algebra."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fieldlens.functions import geodesy, shapes
from fieldlens.operators import grid, nearest, overlay
from fieldlens.sources import export, layers
from fieldlens.sources.schemas import SHAPE


def polygons(spark, rings):
    """A layer from {id: [ring, ...]} with open or closed rings, first the shell."""
    close = lambda r: list(r) + ([r[0]] if r[0] != r[-1] else [])
    rows = [(i, [[(float(x), float(y)) for x, y in close(r)] for r in rs]) for i, rs in rings.items()]
    frame = spark.createDataFrame(rows, "id long, rings array<array<struct<x:double,y:double>>>")
    return shapes.with_bounds(frame.select("id", shapes.polygon_shape(F.col("rings")).alias("shape")))


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def regular(cx, cy, r, n, turn=0.0):
    return [(cx + r * math.cos(turn + 2 * math.pi * k / n), cy + r * math.sin(turn + 2 * math.pi * k / n)) for k in range(n)]


def cut_area(a, b):
    """Area of the common part of two convex counter-clockwise rings: brute force for tests."""
    out = list(a)
    for k in range(len(b)):
        (px, py), (qx, qy) = b[k], b[(k + 1) % len(b)]
        side = lambda p: (qx - px) * (p[1] - py) - (qy - py) * (p[0] - px)
        ring, out = out, []
        for i in range(len(ring)):
            s, e = ring[i], ring[(i + 1) % len(ring)]
            ds, de = side(s), side(e)
            if ds >= 0:
                out.append(s)
            if ds * de < 0:
                t = ds / (ds - de)
                out.append((s[0] + t * (e[0] - s[0]), s[1] + t * (e[1] - s[1])))
        if not out:
            return 0.0
    return abs(sum(out[i][0] * out[(i + 1) % len(out)][1] - out[(i + 1) % len(out)][0] * out[i][1] for i in range(len(out)))) / 2


@pytest.fixture(scope="module")
def random_layers(spark):
    rnd = random.Random(7)
    make = lambda n, r0, r1: {
        i: [regular(rnd.uniform(0, 4000), rnd.uniform(0, 4000), rnd.uniform(r0, r1), rnd.randint(3, 9), rnd.uniform(0, 6))] for i in range(n)
    }
    a, b = make(60, 50, 400), make(40, 100, 600)
    return a, b, polygons(spark, a), polygons(spark, b)


def test_pair_areas_match_brute_force(random_layers):
    a, b, la, lb = random_layers
    want = {(i, j): cut_area(a[i][0], b[j][0]) for i in a for j in b}
    want = {k: v for k, v in want.items() if v > 1e-6}
    got = {(r.a, r.b): r.area for r in overlay.pair_areas(la, lb).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(v, rel=1e-9) for k, v in want.items())
    met = {(r.id_left, r.id_right) for r in grid.spatial_join(la, lb).select("id_left", "id_right").collect()}
    assert met == want.keys()


def test_overlay_algebra_and_tile_independence(random_layers):
    _, _, la, lb = random_layers
    areas = {}
    for size, cap in ((500.0, 8), (3000.0, 1000)):
        rows = overlay.areas_against(la, lb, size=size, cap=cap).orderBy("id").collect()
        union = overlay.union_area(la, lb, size=size, cap=cap).first().area
        mine = overlay.union_area(la, size=size, cap=cap).first().area
        other = overlay.union_area(lb, size=size, cap=cap).first().area
        areas[size] = ([r.inside for r in rows], union, mine, other)
        left = {r.id: r.erase_area for r in overlay.erase(la, lb, size=size, cap=cap).collect()}
        for r in rows:
            assert r.inside + left.get(r.id, 0.0) == pytest.approx(r.area, rel=1e-9)
        common = overlay.clip_pieces(overlay.dissolve(la, size=size, cap=cap).withColumn("id", F.monotonically_increasing_id()).select("id", "shape", "x0", "y0", "x1", "y1"), lb, size=size, cap=cap)
        assert union == pytest.approx(mine + other - common.agg(F.sum("area")).first()[0], rel=1e-9)
    a, b = areas.values()
    assert a[0] == pytest.approx(b[0], rel=1e-9) and a[1:] == pytest.approx(b[1:], rel=1e-9)


def test_degenerate_cases(spark):
    one = polygons(spark, {1: [box(0, 0, 10, 10)], 2: [box(0, 0, 10, 10)], 3: [box(10, 0, 5, 10)], 4: [box(2, 2, 3, 3)], 5: [box(8, 8, 6, 6)]})
    assert {(r.a, r.b) for r in overlay.overlap_pairs(one).collect()} == {(1, 5), (2, 5), (3, 5)}
    holed = polygons(spark, {1: [box(0, 0, 30, 30), box(10, 10, 10, 10)]})
    parts = polygons(spark, {1: [box(12, 12, 4, 4)], 2: [box(2, 2, 4, 4)], 3: [box(30, 0, 5, 5)], 4: [box(100, 100, 5, 5)], 5: [box(8, 12, 4, 4)]})
    rows = {r.id: (r.clip_area, r.touch_only) for r in overlay.clip(parts, holed).collect()}
    assert rows == {2: (16.0, False), 3: (0.0, True), 5: (8.0, False)}
    assert [r.id for r in overlay.within_union(parts, holed).collect()] == [2]
    assert {r.id: r.erase_area for r in overlay.erase(parts, holed).collect()} == {1: 16.0, 3: 25.0, 4: 25.0, 5: 8.0}
    empty = holed.where("false")
    assert overlay.clip(parts, empty).count() == 0 and overlay.erase(parts, empty).count() == 5
    assert grid.spatial_join(parts, empty, "left").count() == 5
    assert nearest.nearest_distance(parts, empty).where("distance_m is null").count() == 5


def test_many_copies_and_a_crowd(spark):
    """A third of the rows in one place: copies never meet each other, and the rest is exact."""
    rnd = random.Random(3)
    copies = spark.range(3000).select("id", *[F.lit(v).alias(c) for c, v in zip(("x0", "y0", "x1", "y1"), (5, 5, 9, 9))])
    far = [(10000 + i, rnd.randint(0, 900), rnd.randint(0, 900)) for i in range(300)]
    others = spark.createDataFrame(far, "id long, x0 int, y0 int").select("id", "x0", "y0", (F.col("x0") + 7).alias("x1"), (F.col("y0") + 7).alias("y1"))
    layer = copies.unionByName(others)
    boxes = [(i, x, y, x + 7, y + 7) for i, x, y in far]
    hit = sum(1 for _, x, y, u, v in boxes if x < 9 and u > 5 and y < 9 and v > 5)
    cross = sum(1 for m, p in enumerate(boxes) for q in boxes[m + 1:] if p[1] < q[3] and q[1] < p[3] and p[2] < q[4] and q[2] < p[4] and p[1:] != q[1:])
    swallowed = sum(1 for _, x, y, u, v in boxes if x <= 5 and y <= 5 and u >= 9 and v >= 9)
    assert overlay.overlap_pairs(layer).count() == 3000 * (hit - swallowed) + cross


def test_nearest_matches_brute_force(spark):
    rnd = random.Random(11)
    pts = [(i, rnd.uniform(0, 50000), rnd.uniform(0, 50000)) for i in range(150)] + [(500 + i, 7000 + rnd.random(), 9000 + rnd.random()) for i in range(80)]
    segs = [(i, *(rnd.uniform(0, 50000) for _ in range(2))) for i in range(60)] + [(200 + i, 7000 + 30 * rnd.random(), 9000 + 30 * rnd.random()) for i in range(150)]
    segs = [(i, x, y, x + rnd.uniform(-800, 800), y + rnd.uniform(-800, 800)) for i, x, y in segs]
    left = shapes.with_bounds(spark.createDataFrame(pts, "id long, px double, py double").select("id", shapes.point_shape(F.col("px"), F.col("py")).alias("shape")))
    p = shapes.point
    right = shapes.with_bounds(
        spark.createDataFrame(segs, "id long, a double, b double, c double, d double").select(
            "id", shapes.line_shape(F.array(p(F.col("a"), F.col("b")), p(F.col("c"), F.col("d")))).alias("shape")
        )
    )

    def gap(x, y, ax, ay, bx, by):
        t = max(0.0, min(1.0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
        return math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay))

    want = {i: min(gap(x, y, *s[1:]) for s in segs) for i, x, y in pts}
    got = {r.id: r.distance_m for r in nearest.nearest_distance(left, right).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in want.items())
    near = {(r.a, r.b) for r in nearest.within_distance(left, right, 900.0).collect()}
    assert near == {(i, s[0]) for i, x, y in pts for s in segs if gap(x, y, *s[1:]) <= 900.0}


def test_distance_is_zero_inside_a_polygon(spark):
    inner, outer = polygons(spark, {1: [box(40, 40, 5, 5)], 2: [box(200, 0, 5, 5)]}), polygons(spark, {9: [box(0, 0, 100, 100)]})
    assert {r.id: r.distance_m for r in nearest.nearest_distance(inner, outer).collect()} == {1: 0.0, 2: 100.0}


def test_utm_known_points(spark):
    pts = spark.createDataFrame([(21.0, 45.0), (19.61, 44.97)], "lon double, lat double")
    u = geodesy.to_utm(F.col("lon"), F.col("lat"))
    rows = pts.select("lon", "lat", u.alias("u"), geodesy.from_utm(u["x"], u["y"]).alias("b")).collect()
    assert rows[0].u.x == pytest.approx(500000.0, abs=1e-6)
    assert all(abs(r.b.x - r.lon) < 1e-9 and abs(r.b.y - r.lat) < 1e-9 for r in rows)


def test_zone_area_of_a_right_angle(spark):
    p = lambda x, y: shapes.point(F.lit(float(x)), F.lit(float(y)))
    bend = shapes.with_bounds(spark.range(1).select("id", shapes.line_shape(F.array(p(0, 0), p(100, 0), p(100, 100))).alias("shape")))
    area = overlay.shape_areas(overlay.zone(bend, 10.0)).first().area
    # two strips, two round ends, a quarter disc outside the bend, less the square counted twice inside it
    exact = 2 * 100 * 20 + math.pi * 100 * (1 + 0.25) - 100
    assert area == pytest.approx(exact, rel=2e-3)


def test_invalid_shapes_and_geojson_round_trip(spark, tmp_path):
    good = polygons(spark, {1: [box(0, 0, 30, 30), box(10, 10, 10, 10)], 2: [box(50, 50, 5, 5)]})
    null = good.limit(1).withColumns({"id": F.lit(3).cast("long"), "shape": F.lit(None).cast(SHAPE)})
    ok, rejected = layers.split_invalid(good.unionByName(null))
    assert ok.count() == 2 and [r.reason for r in rejected.collect()] == ["missing"]
    export.write_geojson(good.withColumn("name", F.lit("ж\"x")), str(tmp_path / "g"))
    back = layers.read_layer(spark, str(tmp_path / "g"), "geojson", StructType([StructField("id", LongType()), StructField("name", StringType())]))
    rows = {r.id: r for r in back.withColumn("area", shapes.area(F.col("shape"))).collect()}
    assert rows[1].area == 800.0 and rows[2].area == 25.0 and rows[1]["name"] == 'ж"x'
    assert (rows[2].x0, rows[2].y1) == (50.0, 55.0)


def test_several_points_survive_export(spark, tmp_path):
    p = lambda x, y: shapes.point(F.lit(float(x)), F.lit(float(y)))
    shape = shapes.make_shape("point", F.array(F.array(p(1, 2)), F.array(p(3, 4))))
    export.write_geojson(shapes.with_bounds(spark.range(1).select("id", shape.alias("shape"))), str(tmp_path / "g"))
    row = layers.read_layer(spark, str(tmp_path / "g"), "geojson", StructType([StructField("id", LongType())])).first()
    assert [(q.x, q.y) for ring in row["shape"].parts for q in ring] == [(1.0, 2.0), (3.0, 4.0)]


def test_crossing_triangles(spark):
    p = lambda x, y: shapes.point(F.lit(float(x)), F.lit(float(y)))
    tri = lambda *c: shapes.polygon_shape(F.array(F.array(*[p(*v) for v in (*c, c[0])])))
    one = spark.range(1).select(F.lit(1).cast("long").alias("id"), tri((0, 0), (100, 0), (50, 100)).alias("shape"))
    two = spark.range(1).select(F.lit(2).cast("long").alias("id"), tri((0, 100), (50, 0), (100, 100)).alias("shape"))
    a, b = shapes.with_bounds(one), shapes.with_bounds(two)
    common = overlay.pair_areas(a, b).first().area
    assert overlay.union_area(a, b).first().area == pytest.approx(10000 - common)
    assert overlay.clip(a, b).first().clip_area == pytest.approx(common)
    assert overlay.erase(a, b).first().erase_area == pytest.approx(5000 - common)


def test_plans_have_no_nested_loops(random_layers):
    _, _, la, lb = random_layers
    for frame in (grid.spatial_join(la, lb), overlay.clip(la, lb), overlay.overlap_pairs(la), nearest.nearest_distance(la, lb)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text
