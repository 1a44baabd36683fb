"""Layers, register tables and pixels derived from the driver's tables.

Each is one SQL text with table placeholders, so that the same text serves Spark here and
the checking engine in ``oracles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators.spread import spread

LAND = """select p_partkey id, x0, x0+w x1, y0, y0+h y1 from (select p_partkey,
  (p_partkey*7919)%400*100 x0, (1+(p_partkey*31)%9)*100 w,
  (p_partkey*104729)%311*100 y0, (1+(p_partkey*37)%9)*100 h from {part}) q"""
ZONE = """select s_suppkey id, x0, x0+w x1, y0, y0+h y1 from (select s_suppkey,
  (s_suppkey*7507)%400*100 x0, (3+(s_suppkey*11)%8)*100 w,
  (s_suppkey*3323)%311*100 y0, (3+(s_suppkey*7)%8)*100 h from {supplier}) q"""
LINE = """select s_suppkey id, x0, case when s_suppkey%2=0 then x0+2000 else x0 end x1,
  y0, case when s_suppkey%2=0 then y0 else y0+2000 end y1
  from (select s_suppkey, (s_suppkey*7507+13)%40000 x0, (s_suppkey*3323+17)%31000 y0 from {supplier}) q"""
FIELD = """select p_partkey id, (p_partkey*7919)%40000 x0, (p_partkey*7919)%40000+100+(p_partkey*31)%900 x1,
  (p_partkey*104729)%30000 y0, (p_partkey*104729)%30000+100+(p_partkey*37)%900 y1 from {part}"""
HOUSE = """select c_custkey id, (c_custkey*6151)%40000 x0, (c_custkey*6151)%40000+50+(c_custkey*13)%200 x1,
  (c_custkey*50021)%30000 y0, (c_custkey*50021)%30000+50+(c_custkey*17)%200 y1 from {customer}"""
OBS = """select l_partkey pixel_id, (l_partkey*7919)%40000 x, (l_partkey*104729)%31000 y,
  year(l_shipdate)*12+month(l_shipdate) scene_id, l_shipdate ts,
  ((year(l_shipdate)*12+month(l_shipdate))*37)%100 cloud,
  l_tax+cast(0.02 as double) blue, l_tax+cast(0.01 as double) green, l_discount+cast(0.01 as double) red,
  l_quantity/100 nir, l_discount+l_tax+cast(0.1 as double) swir from {lineitem}"""
WEATHER = """select user_id%4 cx, user_id%3 cy, ts, 280+value/20 temperature_2m,
  value/200000 total_precipitation from {events}"""

ROAD = """select n_nationkey id, n_nationkey%2 upright, case when n_nationkey%2 = 0 then n_nationkey*1200+37
  else n_nationkey*1500+211 end place from {nation}"""
SPOT = """select c_custkey id, (c_custkey*6151)%800*50 x0, (c_custkey*50021)%620*50 y0 from {customer}"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "labels")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derive(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """Run a text whose placeholders name the driver's tables."""
    used = {n: table(spark, folder, n) for n in TABLES if "{" + n + "}" in text}
    return spark.sql(text, **used)


def _shaped(layer: DataFrame, shape: Column) -> DataFrame:
    """The layer with this shape, made in a generator of one row: else the optimizer works it out again wherever it is named."""
    return layer.withColumn("_made", F.explode(F.array(shape))).withColumn("shape", F.col("_made")).drop("_made")


def boxes(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """A box layer with its polygons, over all tasks: a table of a few files would leave the work on shapes to as many."""
    layer = spread(derive(spark, folder, text), "id")
    return _shaped(layer, shapes.box_shape(*[F.col(c) for c in shapes.BOX]))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    p = shapes.point
    ends = F.array(p(F.col("x0"), F.col("y0")), p(F.col("x1"), F.col("y1")))
    return _shaped(spread(derive(spark, folder, LINE), "id"), shapes.line_shape(ends))


def long_roads(spark: SparkSession, folder: str, segments: int = 210, step: float = 200.0) -> DataFrame:
    """Lines of many segments from end to end of the area, level or upright."""
    along = F.transform(F.sequence(F.lit(0), F.lit(segments)), lambda i: i * step - 1000.0)
    spot = lambda t: F.when(F.col("upright") == 1, shapes.point(F.col("place"), t)).otherwise(shapes.point(t, F.col("place")))
    return shapes.with_bounds(derive(spark, folder, ROAD).select("id", shapes.line_shape(F.transform(along, spot)).alias("shape")))


def turned(layer: DataFrame) -> DataFrame:
    """A layer turned by 45 degrees and stretched by the root of two: whole numbers stay whole, areas double."""
    moved = shapes.map_points(F.col("shape"), lambda p: shapes.point(p["x"] - p["y"], p["x"] + p["y"]))
    return shapes.with_bounds(_shaped(layer, moved))


def dense(layer: DataFrame, parts: int = 250) -> DataFrame:
    """The same outlines with every edge in equal parts: shapes of many vertices."""
    step = lambda s, i: shapes.point(s["ax"] + (s["bx"] - s["ax"]) * i / parts, s["ay"] + (s["by"] - s["ay"]) * i / parts)
    cut = lambda r: F.flatten(F.transform(shapes.ring_segments(r), lambda s: F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: step(s, i))))
    rings = F.transform("shape.parts", lambda r: F.concat(cut(r), F.slice(r, 1, 1)))
    return _shaped(layer, shapes.make_shape("polygon", rings))


def holed(layer: DataFrame, rim: float = 100.0) -> DataFrame:
    """Boxes with a hole that leaves a rim."""
    c = F.col
    ring = lambda x0, y0, x1, y1: F.array(*[shapes.point(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])
    rings = F.array(ring(c("x0"), c("y0"), c("x1"), c("y1")), ring(c("x0") + rim, c("y0") + rim, c("x1") - rim, c("y1") - rim))
    return _shaped(layer, shapes.polygon_shape(rings))


def flawed(layer: DataFrame) -> DataFrame:
    """Boxes with a hole; by the id's remainder of 5: 0 a bow-tie, 1 the hole beside the shell, 2 a shell in the shell, 3 a hole over the rim."""
    c, rest = F.col, F.col("id") % 5
    path = lambda *spots: F.array(*[shapes.point(x, y) for x, y in spots])
    box = lambda x0, y0, x1, y1: path((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    tie = path((c("x0"), c("y0")), (c("x1"), c("y1")), (c("x1"), c("y0")), (c("x0"), c("y1")), (c("x0"), c("y0")))
    shell, small = box(*[c(k) for k in ("x0", "y0", "x1", "y1")]), box(c("x0") + 20, c("y0") + 20, c("x0") + 60, c("y0") + 60)
    moved = lambda by: F.reverse(F.transform(small, lambda p: shapes.point(p["x"] - by, p["y"])))
    parts = (
        F.when(rest == 0, F.array(tie)).when(rest == 1, F.array(shell, moved(90))).when(rest == 2, F.array(shell, small))
        .when(rest == 3, F.array(shell, moved(40))).otherwise(F.array(shell, moved(0)))
    )
    return shapes.with_bounds(_shaped(layer, shapes.make_shape("polygon", parts)))
