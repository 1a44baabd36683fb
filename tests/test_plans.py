"""The bundles: overlay suite, detection report, reading a register."""

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators import crops, grid, nearest
from fieldlens.plans.overlays import overlay_preview, overlay_suite
from fieldlens.sources import schemas, tables
from fieldlens.sources.layers import to_planar
from test_spatial import box, polygons


def _road(spark):
    p = lambda x, y: shapes.point(F.lit(float(x)), F.lit(float(y)))
    return shapes.with_bounds(spark.range(1).select("id", shapes.line_shape(F.array(p(0, 0), p(5000, 0))).alias("shape")))


def test_overlay_suite(spark):
    land = polygons(spark, {1: [box(0, 100, 500, 500)], 2: [box(400, 100, 500, 500)], 3: [box(0, 3000, 100, 100)]})
    data = {
        "landuse": land.withColumn("name", F.when(F.col("id") == 1, "north")),
        "natural": polygons(spark, {7: [box(900, 0, 300, 300)]}),
        "buildings": polygons(spark, {4: [box(10, 110, 20, 20)], 5: [box(2000, 2000, 10, 10)]}),
        "roads": _road(spark),
        "waterways": _road(spark),
    }
    out = overlay_suite(data)
    assert set(out) == {
        "road_zones", "building_zones", "clip_landuse_roads", "intersection_landuse_roads", "difference_landuse_roads",
        "union_landuse_natural", "intersects_landuse_natural", "buildings_within_landuse", "building_water_distance", "overlap_landuse",
        "clip_landuse_roads_pieces", "intersection_landuse_roads_pieces", "difference_landuse_roads_pieces", "union_landuse_natural_pieces",
    }
    sums = {n: out[f"{n}_pieces"].agg(F.sum("area")).first()[0] for n in ("clip_landuse_roads", "union_landuse_natural")}
    assert sums["clip_landuse_roads"] == pytest.approx(100000) and sums["union_landuse_natural"] == pytest.approx(550000)
    assert {r.id: round(r.clip_area) for r in out["clip_landuse_roads"].collect()} == {1: 50000, 2: 50000}
    assert out["difference_landuse_roads"].count() == 3 and out["intersection_landuse_roads"].count() == 2
    assert out["union_landuse_natural"].first().area == pytest.approx(500 * 500 * 2 - 100 * 500 + 100 * 100 + 300 * 300)
    pair = out["intersects_landuse_natural"].collect()
    assert [(r.a, r.b, r.left_name, r.right_name, r.area) for r in pair] == [(2, 7, "landuse_2", "natural_7", 0.0)]
    assert [r.id for r in out["buildings_within_landuse"].collect()] == [4]
    assert {r.id: r.water_distance_m for r in out["building_water_distance"].collect()} == {4: 110.0, 5: 2000.0}
    assert [(r.a, r.b, r.area) for r in out["overlap_landuse"].collect()] == [(1, 2, 50000.0)]
    count, head = overlay_preview({"x": land})["x"]
    assert count.first()[0] == 3 and "shape" not in head.columns
    assert overlay_suite({"roads": data["roads"]}) == {}


def test_layers_in_degrees_become_metres(spark):
    land = polygons(spark, {1: [box(21.0, 0.0, 0.001, 0.001)], 2: [box(20.0, 45.0, 0.01, 0.01)]})
    planar = to_planar({"landuse": land})["landuse"]
    rows = {r.id: r for r in planar.select("*", shapes.area(F.col("shape")).alias("area")).collect()}
    # on the central meridian at the equator: 500 km easting, 0 northing, scale 0.9996
    assert (rows[1].x0, rows[1].y0) == (pytest.approx(500000), pytest.approx(0, abs=1e-6))
    assert rows[1].x1 - rows[1].x0 == pytest.approx(111.3195 * 0.9996, abs=0.001)
    assert rows[1].y1 - rows[1].y0 == pytest.approx(110.5743 * 0.9996, abs=0.001)
    assert rows[2].area == pytest.approx(78848.6 / 100 * 111137.8 / 100 * 0.9996**2, rel=2e-3)


def test_detection_report(spark):
    scored = spark.sql("""select id sample_id, 19.5D + id/10D longitude, 45.0D latitude, 0.7D ndvi, 20.0D temperature,
      60.0D humidity, 0.5D probability, 'Soja' predicted from range(3)""")
    found = crops.detections(scored)
    land = polygons(spark, {1: [box(19.49, 44.9, 0.05, 0.2)], 2: [box(19.4, 44.9, 0.15, 0.2)]})
    planar = polygons(spark, {0: [box(0, 50, 10, 10)], 1: [box(0, -5, 10, 10)], 2: [box(0, 500, 10, 10)]}).withColumnRenamed("id", "detection_id")
    out = crops.detection_report(found, {"landuse": land, "roads": _road(spark)}, planar)
    assert out["class_stats"].first().n == 3
    assert out["landuse_overlap"].count() == 4 and tuple(out["landuse_matched"].first()) == (1, 3)
    assert tuple(out["road_distance_stats"].first()) == (0.0, 500.0, pytest.approx(550 / 3))


def test_register_round_trip(spark, tmp_path):
    for name, table in schemas.REGISTER.items():
        tables.write_table(spark.createDataFrame([], table.struct), str(tmp_path), name)
    assert {n: f.count() for n, f in tables.read_register(spark, str(tmp_path)).items()} == dict.fromkeys(schemas.REGISTER, 0)
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path), "pg_user")


def test_report_works_out_distances_and_matches_once(spark, monkeypatch):
    calls = []
    for module, name in ((nearest, "nearest_distance"), (grid, "matched_keys")):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, plain=plain, name=name, **k: calls.append(name) or plain(*a, **k))
    found = crops.detections(spark.createDataFrame([(1, 19.1, 44.8, 0.5, 20.0, 60.0, 0.9, "Soja")], "sample_id long, longitude double, latitude double, ndvi double, temperature double, humidity double, probability double, predicted string"))
    land = shapes.with_box_shape(spark.createDataFrame([(7, 19.0, 44.0, 20.0, 45.0)], "id long, x0 double, y0 double, x1 double, y1 double"))
    spots = spark.createDataFrame([(1, 3.0, 4.0)], "detection_id long, x double, y double")
    spots = shapes.with_bounds(spots.select("detection_id", shapes.point_shape(F.col("x"), F.col("y")).alias("shape")))
    out = crops.detection_report(found, {"landuse": land, "roads": _road(spark)}, spots)
    for part in ("road_distance", "road_distance_stats"):
        assert "Join" not in out[part]._jdf.queryExecution().optimizedPlan().toString()
    assert out["landuse_matched"].first().matched == 1 and [r.id for r in out["landuse_overlap"].collect()] == [7]
    assert sorted(calls) == ["matched_keys", "nearest_distance"]
