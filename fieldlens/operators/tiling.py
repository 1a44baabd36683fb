"""Tiles whose size follows the data, so that one dense place does not become one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FINEST = 64
"""A crowded tile is cut into at most FINEST x FINEST parts."""
TILE = ["tf", "tx", "ty"]
TILE_BOX = ("wx0", "wy0", "wx1", "wy1")


def split_factors(boxes: DataFrame, size: float, cap: int) -> DataFrame:
    """(X, Y, tf) for tiles holding more than ``cap`` box centres.

    tf is the number of parts per axis after which no part holds more than ``cap``, or
    FINEST. Centres are counted per finest part first, with map-side combine; the coarser
    counts are sums of at most FINEST**2 rows per tile.
    """

    def part(lo: str, hi: str) -> Column:
        return F.floor((F.col(lo) + F.col(hi)) / 2 * FINEST / size)

    fine = (
        boxes.select(part("x0", "x1").alias("fx"), part("y0", "y1").alias("fy"))
        .groupBy("fx", "fy")
        .count()
        .withColumns({"X": F.floor(F.col("fx") / FINEST), "Y": F.floor(F.col("fy") / FINEST)})
        .repartition("X", "Y")
    )

    def total(step: int) -> Column:
        return F.sum("count").over(
            Window.partitionBy("X", "Y", F.floor(F.col("fx") / step), F.floor(F.col("fy") / step))
        )

    crowd = fine.withColumns({"n1": total(FINEST), "n4": total(FINEST // 4), "n16": total(FINEST // 16)})
    peak = crowd.groupBy("X", "Y").agg(F.max("n1").alias("n1"), F.max("n4").alias("n4"), F.max("n16").alias("n16"))
    tf = F.when(F.col("n4") <= cap, 4).when(F.col("n16") <= cap, 16).otherwise(FINEST)
    return peak.where(F.col("n1") > cap).select("X", "Y", tf.alias("tf"))


def tiled(frame: DataFrame, factors: DataFrame, size: float) -> DataFrame:
    """Every feature once per tile that its box reaches into, with the tile's own box.

    A box that only touches a tile's border is left to the neighbour.
    """

    def reach(lo: str, hi: str, s: Column) -> Column:
        first = F.floor(F.col(lo) / s)
        return F.sequence(first, F.greatest(first, F.ceil(F.col(hi) / s) - 1))

    whole = F.lit(float(size))
    base = frame.withColumn("X", F.explode(reach("x0", "x1", whole))).withColumn(
        "Y", F.explode(reach("y0", "y1", whole))
    )
    known = base.join(factors, ["X", "Y"], "left").withColumn("tf", F.coalesce("tf", F.lit(1)))
    part = whole / F.col("tf")

    def inside(lo: str, hi: str, base_index: str) -> Column:
        start = F.col(base_index) * F.col("tf")
        first = F.greatest(F.floor(F.col(lo) / part), start)
        last = F.least(F.greatest(first, F.ceil(F.col(hi) / part) - 1), start + F.col("tf") - 1)
        return F.sequence(F.least(first, last), last)

    out = known.withColumn("tx", F.explode(inside("x0", "x1", "X"))).withColumn(
        "ty", F.explode(inside("y0", "y1", "Y"))
    )
    return out.drop("X", "Y").withColumns(
        {
            "wx0": F.col("tx") * part,
            "wy0": F.col("ty") * part,
            "wx1": (F.col("tx") + 1) * part,
            "wy1": (F.col("ty") + 1) * part,
        }
    )
