"""Counts and descriptions of tables, layers and results."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.sources.schemas import BOX


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, columns) for each table."""
    rows = [
        t.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(",".join(t.columns)).alias("columns")
        )
        for name, t in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def profile_layers(layers: Mapping[str, DataFrame], srid: int = 4326) -> DataFrame:
    """(layer, features, srid, kinds, columns) for each layer."""
    rows = [
        layer.agg(
            F.count("*").alias("features"), F.array_join(F.sort_array(F.collect_set("shape.kind")), ",").alias("kinds")
        ).select(
            F.lit(name).alias("layer"),
            "features",
            F.lit(srid).alias("srid"),
            "kinds",
            F.lit(",".join(c for c in layer.columns if c not in ("shape", *BOX))).alias("columns"),
        )
        for name, layer in layers.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def summary(
    tables: Mapping[str, DataFrame],
    detections: DataFrame,
    layers: Mapping[str, DataFrame],
    overlays: Mapping[str, DataFrame],
    queries: Mapping[str, DataFrame],
) -> DataFrame:
    """One row per figure: (metric, name, value)."""

    def row(metric: str, name: str, frame: DataFrame) -> DataFrame:
        return frame.select(F.lit(metric).alias("metric"), F.lit(name).alias("name"), F.col("value").cast("long"))

    count = lambda f: f.agg(F.count("*").alias("value"))
    parts = [row("table_rows", n, count(t)) for n, t in tables.items()]
    parts.append(row("detections", "all", count(detections)))
    classes = detections.groupBy("crop_type").agg(F.count("*").alias("value"))
    parts.append(
        classes.select(F.lit("detected_class").alias("metric"), F.col("crop_type").alias("name"), F.col("value").cast("long"))
    )
    one = detections.sparkSession.range(1)
    parts += [row("layer", n, one.select(F.lit(1).alias("value"))) for n in layers]
    parts.append(row("overlay_results", "all", one.select(F.lit(len(overlays)).alias("value"))))
    parts.append(row("register_queries", "all", one.select(F.lit(len(queries)).alias("value"))))
    return reduce(DataFrame.unionByName, parts)
