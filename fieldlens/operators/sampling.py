"""Repeatable samples and exact ranks that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.spectral import MIX_SPAN, mix

BUCKETS = 1 << 16


def sample_n(frame: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """min(n, rows) rows in a scattered order of the key; each task keeps at most n."""
    order = mix(F.col(key), seed) if _integral(frame, key) else F.xxhash64(F.col(key), F.lit(seed))
    return frame.orderBy(order, key).limit(n)


def _integral(frame: DataFrame, key: str) -> bool:
    return frame.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")


def ranked(frame: DataFrame, group: str, order: Column, span: int, key: str, name: str = "rank") -> DataFrame:
    """row_number over (partition by group order by order, key), without one task per group.

    ``order`` lies in [0, span). It is cut into equal buckets; a bucket's offset is a
    running sum over the bucket counts, and rows are numbered inside their bucket only.
    """
    cut = frame.withColumn("_o", order).withColumn("_b", F.floor(F.col("_o") * BUCKETS / span))
    counts = cut.groupBy(group, "_b").count()
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(group)
    offsets = counts.select(
        F.col(group).alias("_g"),
        F.col("_b").alias("_gb"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"),
        F.sum("count").over(total).alias("_n"),
    )
    inside = F.row_number().over(Window.partitionBy(group, "_b").orderBy("_o", key))
    return (
        cut.join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_b") == F.col("_gb")))
        .withColumn(name, F.col("_before") + inside)
        .drop("_o", "_b", "_g", "_gb", "_before")
        .withColumnRenamed("_n", f"{name}_of")
    )


def stratified_split(frame: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``: exactly round(share * rows) of every class, chosen by the key."""
    order, span = mix(F.col(key), seed), MIX_SPAN
    r = ranked(frame, label, order, span, key, "_rank")
    return r.withColumn("is_test", F.col("_rank") <= F.round(F.col("_rank_of") * F.lit(test_share))).drop("_rank", "_rank_of")
