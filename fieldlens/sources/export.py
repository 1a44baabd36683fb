"""GeoJSON lines for maps and other tools, thinned and capped on request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators.sampling import sample_n
from fieldlens.sources.schemas import BOX

# Features per layer on a map, and vertex tolerance in degrees.
MAP_LIMITS = {"buildings": 8000, "landuse": 29140, "roads": 8000, "waterways": 2322, "natural": 18}
OTHER_LIMIT = 5000
TOLERANCE = 0.0001
BUILDING_TOLERANCE = 0.00005


def thin(layer: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Snap vertices to a grid of the tolerance and drop repeats.

    A ring or line that would lose its form keeps its own vertices, so a ring never has
    fewer than four points and a line never fewer than two.
    """
    t = F.lit(float(tolerance))

    def snapped(part: Column) -> Column:
        pts = F.transform(part, lambda p: shapes.point(F.round(p["x"] / t) * t, F.round(p["y"] / t) * t))
        return F.filter(pts, lambda p, i: (i == 0) | (p != F.get(pts, i - 1)))

    least = F.when(F.col("shape.kind") == "polygon", 4).when(F.col("shape.kind") == "line", 2).otherwise(1)
    parts = F.transform("shape.parts", lambda r: F.when(F.size(snapped(r)) >= least, snapped(r)).otherwise(r))
    out = layer.withColumn("shape", F.struct(F.col("shape.kind").alias("kind"), parts.alias("parts")))
    return shapes.with_bounds(out)


def map_layer(name: str, layer: DataFrame, key: str = "id", limit: int | None = None) -> DataFrame:
    """A layer thinned as a map shows it: all of it, or a repeatable sample of ``limit`` features.

    The usual limits of a browser map are ``map_limit(name)``.
    """
    shown = layer if limit is None else sample_n(layer, limit, 42, key)
    return thin(shown, BUILDING_TOLERANCE if name == "buildings" else TOLERANCE)


def map_limit(name: str) -> int:
    return MAP_LIMITS.get(name, OTHER_LIMIT)


def geojson_lines(layer: DataFrame) -> DataFrame:
    """One GeoJSON feature per row, in column ``value``."""
    shape = F.col("shape")
    pair = lambda p: F.array(p["x"], p["y"])
    lines = F.to_json(F.transform(shape["parts"], lambda r: F.transform(r, pair)))
    first = F.to_json(F.transform(shape["parts"][0], pair))
    spot = F.to_json(pair(shape["parts"][0][0]))
    spots = F.to_json(F.transform(F.flatten(shape["parts"]), pair))
    # every counter-clockwise ring opens a polygon, clockwise rings are holes of the one before
    rings = F.aggregate(
        shape["parts"],
        F.array().cast("array<array<array<struct<x:double,y:double>>>>"),
        lambda acc, r: F.when(
            (shapes.ring_area(r) >= 0) | (F.size(acc) == 0), F.concat(acc, F.array(F.array(r)))
        ).otherwise(
            F.concat(
                F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.concat(F.element_at(acc, -1), F.array(r))),
            )
        ),
    )
    polygons = F.to_json(F.transform(rings, lambda g: F.transform(g, lambda r: F.transform(r, pair))))
    many = F.size(shape["parts"]) > 1
    geometry = (
        F.when(shape["kind"] == "polygon", F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), polygons, F.lit("}")))
        .when((shape["kind"] == "line") & many, F.concat(F.lit('{"type":"MultiLineString","coordinates":'), lines, F.lit("}")))
        .when(shape["kind"] == "line", F.concat(F.lit('{"type":"LineString","coordinates":'), first, F.lit("}")))
        .when((shape["kind"] == "point") & (F.size(F.flatten(shape["parts"])) > 1), F.concat(F.lit('{"type":"MultiPoint","coordinates":'), spots, F.lit("}")))
        .when(shape["kind"] == "point", F.concat(F.lit('{"type":"Point","coordinates":'), spot, F.lit("}")))
        .otherwise(F.lit("null"))
    )
    rest = [c for c in layer.columns if c != "shape" and c not in BOX]
    props = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})
    return layer.select(
        F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), geometry, F.lit("}")).alias("value")
    )


def write_geojson(layer: DataFrame, path: str) -> None:
    geojson_lines(layer).write.mode("errorifexists").text(path)
