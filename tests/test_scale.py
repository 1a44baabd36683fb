"""Steps that must stay small on large tables: joins on cells, segments, areas of pairs, cells of features."""

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators import cells, grid, meeting, overlay
from fieldlens.plans.derived import turned


def _squares(spark, rows):
    return shapes.with_box_shape(spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double"))


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_joins_on_cells_broadcast_no_layer(spark):
    a, b = _squares(spark, [(1, 0.0, 0.0, 4.0, 4.0)]), _squares(spark, [(7, 3.0, 3.0, 9.0, 9.0)])
    for found in (grid.box_pairs(a, b), grid.matched_keys(a, b, direct=None)):
        assert "BroadcastHashJoin" not in _plan(found)
    assert [(r.l.id, r.r.id) for r in grid.box_pairs(a, b).collect()] == [(1, 7)]


def test_long_segments_meet_short_ones_in_small_cells(spark):
    ends = "struct(double({0}) as ax, double({1}) as ay, double({2}) as bx, double({3}) as by) as s"
    long = spark.sql("select 1 _g, " + ends.format(0, 0, 1000, 1000)).union(spark.sql("select 2 _g, " + ends.format(505, 0, 505, 900)))
    box = {"x0": F.least("s.ax", "s.bx"), "y0": F.least("s.ay", "s.by"), "x1": F.greatest("s.ax", "s.bx"), "y1": F.greatest("s.ay", "s.by")}
    at = meeting._passed(long.withColumns(box), F.lit(10.0))
    n = {r["_g"]: r["count"] for r in at.groupBy("_g").count().collect()}
    assert 100 <= n[1] <= 320 and 90 <= n[2] <= 95  # not the 10000 cells of the first one's box
    diagonal = {(r.cx, r.cy) for r in at.where("_g = 1").collect()}
    assert {(i, i) for i in range(100)} <= diagonal


def test_areas_of_convex_pairs(spark):
    rows = [(1, 0.0, 0.0, 4.0, 4.0), (2, 2.0, 2.0, 7.0, 5.0), (3, 4.0, 0.0, 6.0, 1.0)]
    a = _squares(spark, rows)
    for layer, by in ((a, 1), (turned(a), 2)):
        twice = layer.union(layer)
        found = {(r.a, r.b): round(r.area, 6) for r in overlay.pair_areas(twice, layer, on=F.col("l.id") < F.col("r.id")).collect()}
        assert found == {(1, 2): 4.0 * by}
        assert overlay.pair_areas(twice, layer, on=F.col("l.id") < F.col("r.id")).count() == 1


def test_convex_rings(spark):
    cases = {
        "0 0, 4 0, 4 4, 0 4, 0 0": True, "0 0, 4 0, 1 1, 0 4, 0 0": False, "0 0, 0 4, 4 4, 4 0, 0 0": False,
        "0 0, 4 4, 4 0, 0 4, 0 0": False, "0 0, 2 0, 4 0, 4 4, 0 0": True, "0 0, 4 0, 4 0, 4 4, 0 0": False,
        "0 0, 4 0, 4 4, 0 4": False,
    }
    for text, convex in cases.items():
        spots = F.array(*[shapes.point(*[F.lit(float(v)) for v in p.split()]) for p in text.split(", ")])
        got = spark.range(1).select(shapes.is_convex(shapes.make_shape("polygon", F.array(spots))).alias("c")).first().c
        assert got is convex, text


def test_cells_of_features_do_not_depend_on_their_number(spark):
    many = cells.prepared(_squares(spark, [(i, 1.0, 1.0, 2.0 + i, 2.0 + i) for i in range(40)]), ["id"])
    assert cells.crowded(many, size=100.0, cap=8).count() == 1
    assert cells.crowded_by_one(many, "id", 100.0, 8).count() == 0


@pytest.mark.parametrize("cap", [256, 8])
def test_clip_and_erase_over_merged_cells(spark, cap):
    a = _squares(spark, [(i, 10.0 * i, 5.0, 10.0 * i + 30, 45.0) for i in range(6)])
    b = _squares(spark, [(j, 7.0 * j, 8.0 * (j % 4), 7.0 * j + 12, 8.0 * (j % 4) + 20) for j in range(12)])
    inside = {(x, y) for _, x0, y0, x1, y1 in [(j, 7 * j, 8 * (j % 4), 7 * j + 12, 8 * (j % 4) + 20) for j in range(12)] for x in range(x0, x1) for y in range(y0, y1)}
    want = {i: sum((x, y) in inside for x in range(10 * i, 10 * i + 30) for y in range(5, 45)) for i in range(6)}
    got = {r.id: (r.area, r.inside) for r in overlay.areas_against(a, b, size=64.0, cap=cap).collect()}
    assert {i: round(v[1], 6) for i, v in got.items()} == {i: float(n) for i, n in want.items()}
    assert all(abs(v[0] - 1200.0) < 1e-6 for v in got.values())
