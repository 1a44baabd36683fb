"""Which polygons are not valid, and why: rings that cross, holes outside their shell, shells inside another.

Edges of a large feature meet on grid cells of their own size, like the features of two layers, so a shape of many thousand
vertices costs its edges and the crossings themselves, never all pairs of its edges. Small features are tested in their row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators import grid
from fieldlens.sources.schemas import BOX

CROSSING, OUTSIDE, NESTED = "edges cross", "hole outside its shell", "shell inside a shell"


FEW = 64
"""Polygons of at most so many segments are tested in their row, larger ones by a join of their edges on cells."""


def _listed(shape: Column) -> Column:
    """The edges of every ring with their boxes, numbered along it; repeated vertices have none."""
    low, high = lambda s, a, b: F.least(s[a], s[b]), lambda s, a, b: F.greatest(s[a], s[b])

    def numbered(own: Column, ring: Column) -> Column:
        return F.transform(own, lambda s, n: F.struct(
            ring.alias("ring"), (F.size(own) - 1).alias("last"), n.alias("n"), s.alias("s"), low(s, "ax", "bx").alias("x0"),
            low(s, "ay", "by").alias("y0"), high(s, "ax", "bx").alias("x1"), high(s, "ay", "by").alias("y1")))

    def one(points: Column, ring: Column) -> Column:
        own = F.filter(shapes.ring_segments(points), lambda s: (s["ax"] != s["bx"]) | (s["ay"] != s["by"]))
        return F.element_at(F.transform(F.array(own), lambda o: numbered(o, ring)), 1)

    return F.flatten(F.transform(shape["parts"], one))


def _edges(polygons: DataFrame, key: str) -> DataFrame:
    """(key, ring, last, n, s, box): the edges of polygons, one a row."""
    return polygons.select(key, F.inline(_listed(F.col("shape"))))


def _side(s: Column, x: Column, y: Column) -> Column:
    return F.signum((s["bx"] - s["ax"]) * (y - s["ay"]) - (s["by"] - s["ay"]) * (x - s["ax"]))


def _faulty(l: Column, r: Column) -> Column:
    """Two edges of one feature that meet as a valid polygon's never do.

    Within a ring, neighbours share only their vertex and others nothing. Edges of different rings may touch in a point,
    but neither cross nor run along each other.
    """
    s, t = l["s"], r["s"]
    along = (s["bx"] - s["ax"]) * (t["bx"] - t["ax"]) + (s["by"] - s["ay"]) * (t["by"] - t["ay"])
    level = (_side(s, t["ax"], t["ay"]) == 0) & (_side(s, t["bx"], t["by"]) == 0)
    crossing = (_side(s, t["ax"], t["ay"]) * _side(s, t["bx"], t["by"]) < 0) & (_side(t, s["ax"], s["ay"]) * _side(t, s["bx"], s["by"]) < 0)
    # on one line, more than a point is shared if the common box has an extent
    shared = (F.least(l["x1"], r["x1"]) > F.greatest(l["x0"], r["x0"])) | (F.least(l["y1"], r["y1"]) > F.greatest(l["y0"], r["y0"]))
    neighbours = (F.abs(l["n"] - r["n"]) == 1) | (F.abs(l["n"] - r["n"]) == l["last"])
    spike = level & (along < 0)
    return F.when(l["ring"] != r["ring"], crossing | (level & shared)).when(neighbours, spike).otherwise(shapes.segments_meet(s, t))


def crossings(layer: DataFrame, key: str = "id") -> DataFrame:
    """Keys of polygons whose edges cross, touch within a ring, or run along each other; one row each."""
    polygons = layer.where((F.col("shape.kind") == "polygon") & F.col(key).isNotNull())
    few = F.coalesce(F.size(F.flatten("shape.parts")) <= FEW, F.lit(False))
    before = lambda l, r: (l["ring"] < r["ring"]) | ((l["ring"] == r["ring"]) & (l["n"] < r["n"]))
    box = lambda e: tuple(e[c] for c in BOX)
    placed = lambda e: F.forall(F.array(*box(e)), lambda v: v.isNotNull() & ~F.isnan(v))
    listed = polygons.where(few).select(key, F.explode(F.array(F.filter(_listed(F.col("shape")), placed))).alias("own"))
    l, r = F.col("l"), F.col("r")
    # one row per pair of edges, which runs in generated code and is not shuffled
    pairs = listed.select(key, "own", F.explode("own").alias("l")).select(key, "l", F.explode("own").alias("r"))
    small = pairs.where(before(l, r) & shapes.boxes_meet(box(l), box(r))).where(_faulty(l, r)).select(key)
    edges = _edges(polygons.where(~few), key)
    met = grid.box_pairs(edges, edges, (l[key] == r[key]) & before(l, r), keyed=True)
    return small.unionByName(met.where(_faulty(l, r)).select(l[key].alias(key))).distinct()


def _depths(shape: Column) -> Column:
    """Of every ring: whether it is a shell, and how many times the other rings cover the middle of its first edge."""

    def one(ring: Column, i: Column) -> Column:
        others = F.filter(shape["parts"], lambda p, j: j != i)
        x, y = (ring[0]["x"] + ring[1]["x"]) / 2, (ring[0]["y"] + ring[1]["y"]) / 2
        depth = shapes.winding(F.flatten(F.transform(others, shapes.ring_segments)), x, y)
        return F.struct((shapes.ring_area(ring) > 0).alias("shell"), depth.alias("depth"))

    return F.transform(shape["parts"], one)


def invalid_polygons(layer: DataFrame, key: str = "id") -> DataFrame:
    """(key, reason) of polygons that are not valid; one reason each, crossing edges before nesting.

    Rings that cross have no nesting to speak of. Shells run counter-clockwise and holes clockwise; a shell lies in no
    other shell (but may lie in a hole), a hole in exactly one. Points, lines and rows without a shape are not judged:
    ``layers.split_invalid`` has the reasons that one row shows by itself and comes first.
    """
    judged = layer.where((F.col("shape.kind") == "polygon") & (F.size("shape.parts") > 0))
    crossed = crossings(judged, key).withColumnRenamed(key, "_key").withColumn("_crossed", F.lit(True))
    several = judged.where(F.size("shape.parts") > 1).select(F.col(key).alias("_key"), F.explode(F.array(_depths(F.col("shape")))).alias("_rings"))
    loose = F.exists("_rings", lambda d: ~d["shell"] & (d["depth"] != 1))
    nested = F.exists("_rings", lambda d: d["shell"] & (d["depth"] != 0))
    nesting = several.select("_key", F.when(loose, OUTSIDE).when(nested, NESTED).alias("_nesting")).where("_nesting is not null")
    found = crossed.join(nesting, "_key", "full_outer")
    return found.select(F.col("_key").alias(key), F.when(F.col("_crossed"), CROSSING).otherwise(F.col("_nesting")).alias("reason"))


def split_polygons(layer: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Valid features, and the rest with the reason."""
    bad = invalid_polygons(layer, key).withColumnRenamed(key, "_key")
    return (
        layer.join(bad, F.col(key) == F.col("_key"), "left_anti"),
        layer.join(bad, F.col(key) == F.col("_key")).drop("_key"),
    )
