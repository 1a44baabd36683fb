"""Vector layers: reading, enrichment, region filter, and frames made fit for output."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.functions import shapes
from fieldlens.functions.geodesy import reproject
from fieldlens.operators.scenes import WINDOW
from fieldlens.sources.schemas import BOX, SHAPE

LAYERS = ("landuse", "buildings", "roads", "waterways", "natural")

# Class to category for the two area layers. Unlisted classes keep their name.
LANDUSE_CATEGORY = {
    "forest": "forest", "orchard": "orchard", "vineyard": "vineyard", "farmland": "farmland",
    "farmyard": "farmland", "meadow": "meadow", "grass": "grass", "heath": "heath", "scrub": "scrub",
    "residential": "residential", "industrial": "industrial", "commercial": "commercial",
    "retail": "commercial", "quarry": "quarry", "military": "industrial", "park": "park",
    "recreation_ground": "park", "allotments": "farmland", "cemetery": "park", "landfill": "industrial",
    "village_green": "grass", "greenfield": "grass", "harbour": "water", "nature_reserve": "nature_reserve",
}
NATURAL_CATEGORY = {
    "wood": "forest", "water": "water", "wetland": "wetland", "scrub": "scrub", "heath": "heath",
    "grassland": "grassland", "bare_rock": "bare_rock", "beach": "beach", "sand": "beach",
    "glacier": "bare_rock", "cliff": "cliff", "scree": "bare_rock", "fell": "grassland", "mud": "wetland",
    "shingle": "beach", "spring": "spring", "cave_entrance": "bare_rock", "sinkhole": "bare_rock",
    "rock": "bare_rock", "reef": "bare_rock",
}


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_geojson_lines(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """One GeoJSON feature per line, under a declared property schema."""
    text = spark.read.text(path).select(
        F.from_json(F.get_json_object("value", "$.properties"), properties).alias("p"),
        F.get_json_object("value", "$.geometry.type").alias("t"),
        F.get_json_object("value", "$.geometry.coordinates").alias("c"),
    )
    kinds = {
        "Point": (1, "point"), "MultiPoint": (2, "point"), "LineString": (2, "line"),
        "MultiLineString": (3, "line"), "Polygon": (3, "polygon"), "MultiPolygon": (4, "polygon"),
    }

    def nested(depth: int) -> str:
        return "array<" * depth + "double" + ">" * depth

    def pts(line: Column) -> Column:
        return F.transform(line, lambda q: shapes.point(q[0], q[1]))

    def oriented(rings: Column) -> Column:
        return shapes.polygon_shape(F.transform(rings, pts))["parts"]

    def parts(name: str, depth: int) -> Column:
        c = F.from_json("c", nested(depth))
        return {
            "Point": lambda: F.array(F.array(shapes.point(c[0], c[1]))),
            "MultiPoint": lambda: F.transform(c, lambda q: F.array(shapes.point(q[0], q[1]))),
            "LineString": lambda: F.array(pts(c)),
            "MultiLineString": lambda: F.transform(c, pts),
            "Polygon": lambda: oriented(c),
            "MultiPolygon": lambda: F.flatten(F.transform(c, oriented)),
        }[name]()

    shape = F.lit(None).cast(SHAPE)
    for name, (depth, kind) in kinds.items():
        shape = F.when(F.col("t") == name, shapes.make_shape(kind, parts(name, depth))).otherwise(shape)
    return text.select("p.*", shape.alias("shape"))


def read_layer(
    spark: SparkSession, path: str, fmt: str = "parquet", properties: T.StructType | None = None, srid: int = 4326
) -> DataFrame:
    """A layer in EPSG 4326 with its box columns; any read error raises."""
    frame = read_geojson_lines(spark, path, properties) if fmt == "geojson" else spark.read.parquet(path)
    if srid != 4326:
        frame = frame.withColumn("shape", reproject(F.col("shape"), srid, 4326))
    if srid != 4326 or not set(BOX) <= set(frame.columns):
        frame = shapes.with_bounds(frame)
    return frame


def read_layers(spark: SparkSession, paths: Mapping[str, str], window: tuple[float, ...] = WINDOW, **options) -> dict[str, DataFrame]:
    """The layers whose path exists, filtered to the window and enriched."""
    return {
        name: enrich(name, region_filter(read_layer(spark, path, **options), window))
        for name, path in paths.items()
        if _exists(spark, path)
    }


def to_planar(layers: Mapping[str, DataFrame], srid: int = 32634) -> dict[str, DataFrame]:
    """Layers as read, in EPSG 4326, moved to a UTM zone for areas and distances, with their box columns anew."""
    return {name: shapes.with_bounds(f.withColumn("shape", reproject(F.col("shape"), 4326, srid))) for name, f in layers.items()}


def region_filter(layer: DataFrame, window: tuple[float, ...] = WINDOW) -> DataFrame:
    """Features that share a point with the window; they are not cut.

    The box comparison comes first, as plain columns that Parquet prunes on.
    """
    area = tuple(F.lit(float(v)) for v in window)
    near = layer.where(shapes.boxes_meet(tuple(F.col(c) for c in BOX), area))
    if "shape" not in layer.columns:
        return near
    return near.where(shapes.shapes_meet(F.col("shape"), shapes.box_shape(*area)))


def class_category(frame: DataFrame, mapping: Mapping[str, str], column: str = "fclass", name: str = "category") -> DataFrame:
    """Category of a class from a fixed table of a few dozen entries; others keep their class."""
    table = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return frame.withColumn(name, F.coalesce(F.try_element_at(table, F.col(column)), F.col(column)))


def enrich(name: str, layer: DataFrame) -> DataFrame:
    """The columns that each kind of layer gets on reading."""
    if name == "landuse":
        return class_category(layer.withColumn("type", F.col("fclass")), LANDUSE_CATEGORY)
    if name == "natural":
        return class_category(layer.withColumn("type", F.col("fclass")), NATURAL_CATEGORY)
    if name == "buildings":
        return layer.withColumn("category", F.lit("building"))
    if name == "roads":
        return layer.withColumns({"type": F.col("fclass"), "category": F.lit("road"), "highway": F.col("fclass")})
    if name == "waterways":
        return layer.withColumns({"type": F.col("fclass"), "category": F.lit("waterway")})
    return layer


def split_invalid(layer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable features, and the rest with the reason: missing, empty, not closed, not finite."""
    pts = F.flatten("shape.parts")
    rings = F.col("shape.parts")
    open_ring = (F.col("shape.kind") == "polygon") & F.exists(
        rings, lambda r: (F.size(r) < 4) | (F.element_at(r, 1) != F.element_at(r, -1))
    )
    bad = F.exists(pts, lambda p: p["x"].isNull() | p["y"].isNull() | F.isnan(p["x"]) | F.isnan(p["y"]))
    reason = (
        F.when(F.col("shape").isNull(), "missing")
        .when(F.coalesce(F.size(pts), F.lit(0)) <= 0, "empty")
        .when(bad, "not finite")
        .when(open_ring, "not closed")
    )
    marked = layer.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def drop_geometry(frame: DataFrame) -> DataFrame:
    return frame.drop("shape", *BOX)


def present(frame: DataFrame) -> DataFrame:
    """Rows for output: no geometry, times in one format, everything else as text, NULL as ''."""
    flat = drop_geometry(frame)

    def text(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        return F.coalesce(c.cast("string"), F.lit("")).alias(f.name)

    return flat.select(*[text(f) for f in flat.schema.fields])
