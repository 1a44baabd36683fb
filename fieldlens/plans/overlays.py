"""The overlay suite: every technique over one set of map layers, as lazy frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.operators import nearest, overlay

ROAD_ZONE_M = 200.0
BUILDING_ZONE_M = 500.0


def overlay_suite(layers: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Results by name; those whose layers are missing are left out, without landuse all are.

    Layers are planar, in metres: those that ``read_layers`` gives go through ``layers.to_planar``
    first. Every feature takes part.
    """
    if "landuse" not in layers:
        return {}

    land, out = layers["landuse"], {}
    if "roads" in layers:
        zones = overlay.zone(layers["roads"], ROAD_ZONE_M)
        out["road_zones"] = zones
        if "buildings" in layers:
            out["building_zones"] = overlay.zone(layers["buildings"], BUILDING_ZONE_M)
        out["clip_landuse_roads"] = overlay.clip(land, zones)
        out["clip_landuse_roads_pieces"] = overlay.clip_pieces(land, zones)
        out["intersection_landuse_roads"] = overlay.intersection(land, zones)
        out["intersection_landuse_roads_pieces"] = overlay.intersection_pieces(land, zones)
        out["difference_landuse_roads"] = overlay.erase(land, zones)
        out["difference_landuse_roads_pieces"] = overlay.erase_pieces(land, zones)
    if "natural" in layers:
        out["union_landuse_natural"] = overlay.union_area(land, layers["natural"])
        out["union_landuse_natural_pieces"] = overlay.dissolve(land, layers["natural"])
        out["intersects_landuse_natural"] = overlay.touching_pairs(layers["landuse"], layers["natural"])
    if "buildings" in layers:
        out["buildings_within_landuse"] = overlay.within_union(layers["buildings"], layers["landuse"])
        if "waterways" in layers:
            out["building_water_distance"] = nearest.nearest_distance(
                layers["buildings"], layers["waterways"], "water_distance_m"
            )
    out["overlap_landuse"] = overlay.overlap_pairs(layers["landuse"])
    return out


def overlay_preview(results: dict[str, DataFrame], rows: int = 5) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per result its count and its first rows in the order of the first column."""
    return {
        name: (frame.agg(F.count("*").alias("count")), frame.drop("shape").orderBy(frame.columns[0]).limit(rows))
        for name, frame in results.items()
    }
