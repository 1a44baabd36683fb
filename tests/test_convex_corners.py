"""Whether four corners are convex is told from plain columns, as it is told for any other ring."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions import shapes

RINGS = {
    "box": ([(0, 0), (4, 0), (4, 3), (0, 3), (0, 0)], True),
    "turned": ([(0, 0), (3, 3), (0, 6), (-3, 3), (0, 0)], True),
    "corner on an edge": ([(0, 0), (2, 0), (4, 0), (0, 3), (0, 0)], True),
    "clockwise": ([(0, 0), (0, 3), (4, 3), (4, 0), (0, 0)], False),
    "bow-tie": ([(0, 0), (4, 3), (4, 0), (0, 3), (0, 0)], False),
    "dent": ([(0, 0), (4, 0), (1, 1), (0, 4), (0, 0)], False),
    "same corner twice": ([(0, 0), (4, 0), (4, 0), (0, 3), (0, 0)], False),
    "there and back": ([(0, 0), (4, 0), (2, 0), (1, 0), (0, 0)], False),
    "open": ([(0, 0), (4, 0), (4, 3), (0, 3), (0, 1)], False),
    "triangle": ([(0, 0), (4, 0), (0, 3), (0, 0)], True),
    "five corners": ([(0, 0), (4, 0), (5, 2), (2, 4), (-1, 2), (0, 0)], True),
    "twice around": ([(0, 0), (4, 0), (0, 3), (0, 0), (4, 0), (0, 3), (0, 0)], False),
}


def test_four_corners_like_any_ring(spark):
    rows = [(n, [[(float(x), float(y)) for x, y in r]], e) for n, (r, e) in RINGS.items()]
    frame = spark.createDataFrame(rows, "name string, parts array<array<struct<x:double,y:double>>>, expected boolean")
    shaped = frame.withColumn("shape", shapes.make_shape("polygon", F.col("parts")))
    told = shaped.select("name", "expected", shapes.is_convex(F.col("shape")).alias("told"))
    assert {r.name: r.told for r in told.collect()} == {n: e for n, (_, e) in RINGS.items()}


def test_four_corners_need_no_loop(spark):
    box = spark.range(1).select(shapes.box_shape(F.col("id"), F.col("id"), F.col("id") + 2.0, F.col("id") + 1.0).alias("shape"))
    plan = box.repartition(2).select(shapes.is_convex(F.col("shape"))).toDF("told")._jdf.queryExecution().optimizedPlan().toString()
    assert "= 5)" in plan
