"""Random points in polygons, dealt evenly over the area they cover and the same whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.spectral import MIX_SPAN, mix
from fieldlens.operators import overlay

UNIT = 1e-6
"""Areas are added in whole units, so that sums do not depend on the order of addition."""


def _share(key: Column, seed: int) -> Column:
    """A number in (0, 1) that belongs to a key."""
    return (mix(key, seed) + 0.5) / F.lit(float(MIX_SPAN))


def _before(name: str, *by: str, within: tuple[str, ...] = ()) -> Column:
    """The sum over the rows before this one."""
    rows = Window.partitionBy(*within).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(name).over(rows), F.lit(0))


def _placed(pieces: DataFrame) -> DataFrame:
    """Pieces with the units of area before them (_from): columns of cells, cells, pieces in a cell, one after another.

    Each of the three steps numbers the members of one group; only the columns of cells, one row per cell width of the
    whole extent, are added up in one task.
    """
    ring = F.element_at("shape.parts", 1)
    flat = pieces.withColumn("_u", F.round(F.col("area") / UNIT).cast("decimal(28,0)")).where("_u > 0").withColumn("_ring", ring.cast("string"))
    cell = flat.groupBy("tf", "cx", "cy").agg(F.sum("_u").alias("_cell")).withColumn("_col", F.floor(F.col("cx") / F.col("tf")))
    column = cell.groupBy("_col").agg(F.sum("_cell").alias("_column"))
    column = column.select("_col", _before("_column", "_col").alias("_c0"))
    cell = cell.withColumn("_c1", _before("_cell", "tf", "cx", "cy", within=("_col",))).join(column, "_col")
    start = cell.select("tf", "cx", "cy", (F.col("_c0") + F.col("_c1")).alias("_start"))
    inside = flat.withColumn("_c2", _before("_u", "x0", "y0", "_ring", within=("tf", "cx", "cy")))
    return inside.join(start, ["tf", "cx", "cy"]).withColumn("_from", F.col("_start") + F.col("_c2"))


def random_points(layer: DataFrame, n: int, seed: int = 42, size: float = overlay.SIZE, cap: int = overlay.CAP) -> DataFrame:
    """n points (id from 0, x, y) in the union of a layer's polygons; none where it covers nothing.

    The covered area is cut into n parts of equal size, in the order of cells, and every part gets one point at a random
    place: any stretch of cells has its share of the points to within one. Inside a piece x follows its width and y is even.
    """
    pieces = _placed(overlay.dissolve(layer, size=size, cap=cap))
    total = pieces.agg(F.sum("_u").cast("double").alias("t")).scalar()
    pieces = pieces.withColumn("_t", total).withColumns({"_lo": F.col("_from").cast("double") / F.col("_t"), "_hi": (F.col("_from") + F.col("_u")).cast("double") / F.col("_t")})
    # part k has its point at (k + share) / n of the area
    last = F.least(F.floor(F.col("_hi") * n), F.lit(n - 1).cast("bigint"))
    spots = pieces.withColumn("id", F.explode(F.sequence(F.floor(F.col("_lo") * n), last)))
    spots = spots.withColumn("_at", (F.col("id") + _share(F.col("id"), seed)) / n)
    reach = F.when(F.col("_hi") >= 1.0, F.lit(2.0)).otherwise(F.col("_hi"))  # the last piece takes what rounding leaves over
    spots = spots.where((F.col("_lo") <= F.col("_at")) & (F.col("_at") < reach))

    # a piece has two upright sides: heights h0 at x0 and h1 at x1, one of which may be 0
    at = lambda side, fn: fn(F.transform(F.filter(F.element_at("shape.parts", 1), lambda p: p["x"] == F.col(side)), lambda p: p["y"]))
    sides = spots.select(
        "id", "x0", "x1", at("x0", F.array_min).alias("_b0"), at("x0", F.array_max).alias("_t0"), at("x1", F.array_min).alias("_b1"), at("x1", F.array_max).alias("_t1"),
    ).withColumns({"_h0": F.col("_t0") - F.col("_b0"), "_h1": F.col("_t1") - F.col("_b1")})
    # the share s of the area lies left of f: 2 h0 f + (h1 - h0) f^2 = s (h0 + h1), solved in the form without cancellation
    s, h0, h1 = _share(F.col("id"), seed + 1), F.col("_h0"), F.col("_h1")
    f = s * (h0 + h1) / (h0 + F.sqrt(h0 * h0 + s * (h1 * h1 - h0 * h0)))
    sides = sides.withColumn("_f", F.least(F.greatest(f, F.lit(0.0)), F.lit(1.0)))
    y = lambda v: F.col(f"_{v}0") + (F.col(f"_{v}1") - F.col(f"_{v}0")) * F.col("_f")
    x = F.col("x0") + (F.col("x1") - F.col("x0")) * F.col("_f")
    return sides.select("id", x.alias("x"), (y("b") + (y("t") - y("b")) * _share(F.col("id"), seed + 2)).alias("y"))
