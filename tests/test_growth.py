"""Steps that must not grow faster than the tables: what is tested in a row, what a semi join ends early, what is not shuffled again."""

import random

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators import changes, grid, nearest, overlay, rings, validity
from fieldlens.plans.derived import turned
from fieldlens.sources.schemas import LONG, Field, Link, Table


def _squares(spark, rows):
    return shapes.with_box_shape(spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double"))


def _lines(spark, rows):
    ends = F.array(shapes.point(F.col("ax"), F.col("ay")), shapes.point(F.col("bx"), F.col("by")))
    frame = spark.createDataFrame(rows, "id long, ax double, ay double, bx double, by double")
    return shapes.with_bounds(frame.select("id", shapes.line_shape(ends).alias("shape")))


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_convex_pairs_are_cut_in_their_row(spark, monkeypatch):
    monkeypatch.setattr(rings, "polygons", lambda *a: pytest.fail("convex pairs need no rings"))
    a = _squares(spark, [(1, 0.0, 0.0, 4.0, 4.0), (2, 9.0, 9.0, 12.0, 12.0)])
    b = _squares(spark, [(7, 2.0, 2.0, 6.0, 6.0), (8, 1.0, 1.0, 2.0, 3.0), (9, 4.0, 0.0, 5.0, 4.0)])
    for by, (la, lb) in ((1, (a, b)), (2, (turned(a), turned(b)))):
        found = {(r.left_id, r.right_id): (r.area, len(r["shape"].parts[0])) for r in overlay.intersection_polygons(la, lb).collect()}
        assert found == {(1, 7): (4.0 * by, 5), (1, 8): (2.0 * by, 5)}


def test_left_join_does_not_shuffle_pairs(spark):
    a = _squares(spark, [(1, 0.0, 0.0, 4.0, 4.0), (2, 50.0, 50.0, 51.0, 51.0), (3, 3.0, 3.0, 5.0, 5.0)]).drop("shape")
    rows = a.union(a.where("id = 3")).union(a.where("id = 3").withColumn("id", F.lit(None).cast("long")))
    b = _squares(spark, [(7, 3.0, 3.0, 9.0, 9.0), (8, 0.0, 0.0, 1.0, 1.0)]).drop("shape")
    found = grid.spatial_join(rows, b, "left", ("_a", "_b"))
    assert "LeftOuter" not in _plan(found)
    got = sorted((r.id_a or 0, r.id_b or 0) for r in found.collect())
    assert got == [(0, 0), (1, 7), (1, 8), (2, 0)] + [(3, 7)] * 4


def test_pairs_spread_over_all_tasks(spark):
    a = _squares(spark, [(i, float(i), 0.0, i + 4.0, 4.0) for i in range(40)]).drop("shape")
    assert grid.box_pairs(a, a).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_small_polygons_are_judged_in_their_row(spark):
    ring = lambda *spots: F.array(*[shapes.point(F.lit(float(x)), F.lit(float(y))) for x, y in spots])
    ties = {1: ring((0, 0), (9, 9), (9, 0), (0, 9), (0, 0)), 2: ring((0, 0), (9, 0), (9, 9), (0, 9), (0, 0))}
    layer = None
    for i, r in ties.items():
        row = spark.range(1).select(F.lit(i).alias("id"), shapes.make_shape("polygon", F.array(r)).alias("shape"))
        layer = row if layer is None else layer.union(row)
    found = validity.crossings(layer)
    assert [r.id for r in found.collect()] == [1]
    few = validity.FEW
    try:
        validity.FEW = 0  # the same by the join on cells
        assert [r.id for r in validity.crossings(layer).collect()] == [1]
    finally:
        validity.FEW = few


def test_pieces_of_long_segments_are_short(spark):
    segs = nearest.right_segments(_lines(spark, [(1, 0.0, 0.0, 1600.0, 0.0), (2, 0.0, 0.0, 1600.0, 800.0)]))
    pieces = nearest._pieces(segs)
    assert pieces.where("nx1 - nx0 > 101").count() == 0 and pieces.count() == 2 * nearest.PIECES


@pytest.mark.parametrize("slanted", [False, True])
def test_distances_to_long_lines(spark, slanted):
    rnd = random.Random(5)
    spots = [(i, rnd.uniform(0, 900), rnd.uniform(0, 900)) for i in range(40)]
    left = _squares(spark, [(i, x, y, x + 20, y + 20) for i, x, y in spots])
    ways = [(j, rnd.uniform(0, 900), rnd.uniform(0, 900)) for j in range(12)]
    other = _lines(spark, [(j, x, y, x + (400 if j % 2 or slanted else 0), y + (0 if j % 2 and not slanted else 300)) for j, x, y in ways])
    pairs = left.select("id", F.explode(shapes.segments(F.col("shape"))).alias("s")).crossJoin(
        other.select(F.col("id").alias("b"), F.explode(shapes.segments(F.col("shape"))).alias("t")))
    each = pairs.withColumn("d", shapes.segment_distance(F.col("s"), F.col("t")))
    inside = left.alias("l").crossJoin(other.alias("o")).where(shapes.shapes_meet(F.col("l.shape"), F.col("o.shape"))).select("l.id", F.col("o.id").alias("b"))
    met = {(r.id, r.b) for r in inside.collect()}
    gaps = {(r.id, r.b): 0.0 if (r.id, r.b) in met else r.d for r in each.groupBy("id", "b").agg(F.min("d").alias("d")).collect()}
    least = {i: min(d for (k, _), d in gaps.items() if k == i) for i, _, _ in spots}
    for few in (0,) if slanted else (nearest.FEW,):  # segment by segment, and in the row
        kept, nearest.FEW = nearest.FEW, few
        try:
            got = {r.id: r.distance_m for r in nearest.nearest_distance(left, other).collect()}
            near = {(r.a, r.b) for r in nearest.within_distance(left, other, 60.0).collect()}
        finally:
            nearest.FEW = kept
        assert got == pytest.approx(least)
        assert near == {p for p, d in gaps.items() if d <= 60.0}


def test_cascade_to_a_leaf_by_its_own_key_reads_it_once(spark):
    a, b, c = (Table(n, (Field("k", LONG, True),), key="k") for n in "abc")
    frames = {n: spark.createDataFrame([(i,) for i in rows], "k long") for n, rows in (("a", (1, 2)), ("b", (1, 2, 2, 3)), ("c", (2, 3)))}
    one = changes.delete_with_rules(frames, "a", spark.createDataFrame([(2,), (3,)], "k long"), {"a": a, "b": b, "c": c}, (Link("b", "k", "a"),))
    assert [r.k for r in one["b"].collect()] == [1] and "LeftSemi" not in _plan(one["b"])
    # b has a child: a key that b lacks must not reach it
    two = changes.delete_with_rules(
        {**frames, "b": frames["b"].where("k < 3")}, "a", spark.createDataFrame([(2,), (3,)], "k long"), {"a": a, "b": b, "c": c}, (Link("b", "k", "a"), Link("c", "k", "b"))
    )
    assert [r.k for r in two["b"].collect()] == [1] and [r.k for r in two["c"].collect()] == [3]
