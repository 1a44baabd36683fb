"""Every operator as a query over the driver's tables: name -> f(spark, folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlens.functions import geodesy, shapes
from fieldlens.operators import changes, crops, grid, integrity, nearest, overlay, profile, sampling, scatter, scenes, validity
from fieldlens.operators.spread import checkpointed, shared_folder
from fieldlens.plans import register
from fieldlens.plans.derived import FIELD, HOUSE, LAND, OBS, SPOT, WEATHER, ZONE, boxes, dense, derive, flawed, holed, lines, long_roads, table, turned
from fieldlens.sources import export, layers
from fieldlens.sources.schemas import INT, LONG, TEXT, Field, Link, Table
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DOUBLE = T.DoubleType()


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _dbl(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: F.col(n).cast("double") for n in names})


# ---- register queries -------------------------------------------------------------

PARCEL_OF_LINE = """select concat('P-', l_orderkey, '-', l_linenumber) number, cast(l_quantity as decimal(10,4)) area_ha,
  l_partkey soil_id from {lineitem}"""
SOIL = "select p_partkey id, p_name name, p_brand drainage, cast(p_size as decimal(3,1)) ph from {part}"
CROP_OF_LINE = """select l_orderkey parcel_id, l_returnflag name, concat('v', l_linenumber) variety,
  case when l_linestatus = 'O' then 'aktivan' else 'zavrsen' end status, l_linestatus = 'O' irrigated from {lineitem}"""
PARCEL_OF_ORDER = """select o_orderkey id, concat('P-', o_orderkey) number, o_custkey owner_id,
  cast(o_totalprice as decimal(18,2)) area_ha from {orders}"""
OWNER = """select c_custkey id, c_name first_name, c_mktsegment last_name, c_mktsegment kind,
  concat(c_name, '@') email from {customer}"""
MONITORING_OF_LINE = """select l_orderkey crop_id, cast(l_shipdate as date) as day, cast(l_quantity/50 as decimal(5,4)) ndvi,
  l_returnflag health, l_linestatus problems, concat('op', l_linenumber) operator,
  case l_returnflag when 'A' then null when 'N' then '—' else concat('T', l_linenumber) end treatment from {lineitem}"""
CROP_OF_ORDER = """select o_orderkey id, o_custkey parcel_id, o_orderpriority name, o_orderstatus status,
  o_orderstatus variety from {orders}"""
PARCEL_OF_CUSTOMER = "select c_custkey id, c_name number, c_nationkey municipality_id, c_mktsegment address from {customer}"
MUNICIPALITY = """select n_nationkey id, n_name name, r_name district, r_name town
  from {nation} join {region} on n_regionkey = r_regionkey"""
PARCEL_FULL = """select o_orderkey id, o_custkey owner_id, c_nationkey municipality_id, soil_id from {orders}
  join {customer} on o_custkey = c_custkey
  join (select l_orderkey k, min(l_partkey) soil_id from {lineitem} group by l_orderkey) s on k = o_orderkey"""


@query
def join_range(spark, d):
    return _dbl(register.parcels_with_soil(derive(spark, d, PARCEL_OF_LINE), derive(spark, d, SOIL), 10.0, 20.0), "area_ha", "ph")


@query
def join_three(spark, d):
    return register.crops_with_owner(derive(spark, d, CROP_OF_LINE), derive(spark, d, PARCEL_OF_ORDER), derive(spark, d, OWNER))


@query
def join_measure(spark, d):
    out = register.low_ndvi(derive(spark, d, MONITORING_OF_LINE), derive(spark, d, CROP_OF_ORDER), 0.5)
    return _dbl(out, "ndvi").withColumn("day", F.col("day").cast("string"))


@query
def join_left(spark, d):
    return register.parcels_by_municipality(
        derive(spark, d, PARCEL_OF_CUSTOMER), derive(spark, d, MUNICIPALITY), derive(spark, d, CROP_OF_ORDER), "ASIA"
    )


@query
def owner_totals(spark, d):
    return _dbl(register.owner_totals(derive(spark, d, OWNER), derive(spark, d, PARCEL_OF_ORDER), 1000000.0), "total_area_ha")


@query
def star_five(spark, d):
    return register.irrigated_crops(
        derive(spark, d, CROP_OF_LINE), derive(spark, d, PARCEL_FULL), derive(spark, d, SOIL),
        derive(spark, d, OWNER), derive(spark, d, MUNICIPALITY),
    )


@query
def chain_four(spark, d):
    out = register.treatments(
        derive(spark, d, MONITORING_OF_LINE), derive(spark, d, CROP_OF_ORDER),
        derive(spark, d, PARCEL_OF_CUSTOMER), derive(spark, d, MUNICIPALITY),
    )
    return out.withColumn("day", F.col("day").cast("string"))


# ---- changes and integrity --------------------------------------------------------

CUSTOMER = Table(
    "customer",
    (
        Field("c_custkey", LONG, True),
        Field("c_name", TEXT, True, 17),
        Field("c_nationkey", INT),
        Field("c_acctbal", DOUBLE, default=0.0),
        Field("c_mktsegment", TEXT, False, 9, default="NEW"),
    ),
    key="c_custkey",
    unique=("c_acctbal",),
)
NATION = Table("nation", (Field("n_nationkey", INT, True), Field("n_name", TEXT, True, 8)), key="n_nationkey", unique=("n_name",))
ORDERS = Table(
    "orders",
    (
        Field("o_orderkey", LONG, True),
        Field("o_custkey", LONG, True),
        Field("o_totalprice", T.DecimalType(7, 2)),
        Field("o_orderpriority", TEXT, True, 10),
    ),
    key="o_orderkey",
    unique=("o_totalprice",),
)
LINEITEM = Table("lineitem", (Field("l_orderkey", LONG, True), Field("l_suppkey", LONG)), key="l_orderkey")
SUPPLIER = Table("supplier", (Field("s_suppkey", LONG, True), Field("s_name", TEXT, True, 17)), key="s_suppkey")
DRIVER_TABLES = {t.name: t for t in (CUSTOMER, NATION, ORDERS, LINEITEM, SUPPLIER)}
DRIVER_LINKS = (
    Link("customer", "c_nationkey", "nation"),
    Link("orders", "o_custkey", "customer"),
    Link("lineitem", "l_orderkey", "orders"),
    Link("lineitem", "l_suppkey", "supplier", "set_null"),
)
NEW_CUSTOMERS = "select 1000000000 + s_suppkey c_custkey, s_name c_name, s_nationkey c_nationkey from {supplier}"
BALANCES = "select o_custkey c_custkey, o_totalprice c_acctbal, o_orderdate seq from {orders}"
MIXED = """select o_custkey*2 c_custkey, concat('N-', o_orderkey) c_name, cast(3 as int) c_nationkey, o_totalprice c_acctbal,
  o_orderpriority c_mktsegment, o_orderkey seq,
  case o_orderstatus when 'F' then 'delete' when 'O' then 'update' else 'insert' end action from {orders}"""
POOR = "select s_suppkey from {supplier} where s_acctbal < 500"


@query
def change_insert(spark, d):
    return changes.insert_rows(table(spark, d, "customer"), derive(spark, d, NEW_CUSTOMERS), CUSTOMER)


@query
def change_update(spark, d):
    return changes.update_batch(table(spark, d, "customer"), CUSTOMER, derive(spark, d, BALANCES), "seq")


@query
def change_delete(spark, d):
    return changes.delete_batch(table(spark, d, "customer"), derive(spark, d, POOR), "c_nationkey")


@query
def change_upsert(spark, d):
    return changes.upsert(table(spark, d, "customer"), derive(spark, d, MIXED), CUSTOMER)


@query
def update_one(spark, d):
    return changes.update_where(table(spark, d, "customer"), CUSTOMER, "c_mktsegment", "MOVED", "c_nationkey", 3)


@query
def delete_one(spark, d):
    return changes.delete_where(table(spark, d, "customer"), CUSTOMER, "c_mktsegment", "BUILDING")


@query
def affected_rows(spark, d):
    return changes.count_where(table(spark, d, "customer"), CUSTOMER, "c_mktsegment", "BUILDING")


def _tables(spark, d, *names):
    return {n: table(spark, d, n) for n in names}


def _kept(frames, keys):
    out = None
    for name, key in keys.items():
        row = frames[name].agg(F.count("*").alias("rows"), F.sum(F.col(key)).cast("long").alias("key_sum")).select(
            F.lit(name).alias("table_name"), "rows", "key_sum"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query
def cascade_delete(spark, d):
    frames = _tables(spark, d, "nation", "customer", "orders", "lineitem")
    doomed = derive(spark, d, "select n_nationkey from {nation} join {region} on n_regionkey = r_regionkey where r_name = 'ASIA'")
    left = changes.delete_with_rules(frames, "nation", doomed, DRIVER_TABLES, DRIVER_LINKS)
    return _kept(left, {"nation": "n_nationkey", "customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_partkey"})


@query
def setnull_delete(spark, d):
    frames = _tables(spark, d, "supplier", "lineitem")
    left = changes.delete_with_rules(frames, "supplier", derive(spark, d, POOR), DRIVER_TABLES, DRIVER_LINKS)
    return left["lineitem"].groupBy("l_suppkey").agg(F.count("*").alias("rows"))


@query
def integrity_report(spark, d):
    frames = _tables(spark, d, "nation", "customer", "orders", "supplier", "lineitem")
    orders = frames["orders"]
    turned = {c: -F.col(c) for c in ("o_orderkey", "o_custkey")}  # rows of customers that are in no table
    planted = orders.unionByName(orders.where("o_orderstatus = 'P'").withColumns(turned).select(*orders.columns))
    return integrity.integrity_report(dict(frames, orders=planted), DRIVER_TABLES, DRIVER_LINKS)


# ---- layers and profiles ----------------------------------------------------------

CLASSED = """select p_partkey id, case p_type when 'ECONOMY' then 'farmyard' when 'SMALL' then 'retail'
  when 'MEDIUM' then 'military' when 'PROMO' then 'harbour' when 'STANDARD' then 'mystery' else null end fclass from {part}"""


@query
def class_map(spark, d):
    return layers.enrich("landuse", derive(spark, d, CLASSED))


@query
def enrich_roads(spark, d):
    return layers.enrich("roads", derive(spark, d, CLASSED))


@query
def region_filter(spark, d):
    return layers.region_filter(boxes(spark, d, LAND), (10000, 5000, 20000, 15000)).drop("shape")


@query
def layer_profile(spark, d):
    return profile.profile_layers({"landuse": boxes(spark, d, LAND), "roads": lines(spark, d)}, 32634)


@query
def table_profile(spark, d):
    return profile.profile_tables(_tables(spark, d, "nation", "customer", "orders", "lineitem"))


@query
def sample_n(spark, d):
    return sampling.sample_n(derive(spark, d, LAND), 500)


@query
def present_rows(spark, d):
    return layers.present(table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.expr("nullif(o_orderstatus, 'F')").alias("status")))


@query
def complete_cases(spark, d):
    partial = derive(spark, d, "select event_id, nullif(event_type, 'error') event_type, user_id from {events}")
    return scenes.complete_cases(partial)


@query
def summary(spark, d):
    found = derive(spark, d, "select l_returnflag crop_type from {lineitem}")
    return profile.summary(
        _tables(spark, d, "nation", "customer"), found, {"landuse": None, "roads": None}, {"a": None}, {str(i): None for i in range(7)}
    )


# ---- spatial ----------------------------------------------------------------------


@query
def spatial_pairs(spark, d):
    return grid.spatial_join(derive(spark, d, FIELD), derive(spark, d, HOUSE), suffixes=("_a", "_b")).select("id_a", "id_b")


@query
def spatial_left(spark, d):
    out = grid.spatial_join(derive(spark, d, HOUSE), derive(spark, d, FIELD), "left", ("_a", "_b"))
    return out.select("id_a", "id_b", "x0_a", F.col("x0_b").cast("double").alias("x0_b"))


@query
def exact_pairs(spark, d):
    return grid.spatial_join(boxes(spark, d, LAND), boxes(spark, d, ZONE), suffixes=("_a", "_b")).select("id_a", "id_b")


@query
def dense_pairs(spark, d):
    return grid.spatial_join(turned(boxes(spark, d, LAND)), turned(dense(boxes(spark, d, ZONE))), suffixes=("_a", "_b")).select("id_a", "id_b")


@query
def dense_left(spark, d):
    out = grid.spatial_join(turned(dense(boxes(spark, d, ZONE))), turned(boxes(spark, d, HOUSE)), "left", ("_a", "_b"))
    return out.select("id_a", "id_b")


@query
def unique_matches(spark, d):
    return grid.count_matched(derive(spark, d, FIELD), derive(spark, d, HOUSE))


@query
def touching_pairs(spark, d):
    return overlay.touching_pairs(derive(spark, d, LAND), derive(spark, d, ZONE))


@query
def overlap_pairs(spark, d):
    return overlay.overlap_pairs(derive(spark, d, LAND))


@query
def pair_areas(spark, d):
    return overlay.pair_areas(boxes(spark, d, LAND), boxes(spark, d, ZONE))


@query
def intersection_overlay(spark, d):
    land = derive(spark, d, LAND).join(derive(spark, d, "select p_partkey id, p_type fclass from {part}"), "id")
    zone = derive(spark, d, ZONE).join(derive(spark, d, "select s_suppkey id, s_name name from {supplier}"), "id")
    return overlay.intersection(land, zone)


@query
def clip_area(spark, d):
    return overlay.clip(boxes(spark, d, LAND), boxes(spark, d, ZONE)).select("id", "clip_area", "touch_only")


@query
def erase_area(spark, d):
    return overlay.erase(boxes(spark, d, LAND), boxes(spark, d, ZONE)).select("id", "erase_area")


@query
def union_area(spark, d):
    return overlay.union_area(boxes(spark, d, LAND), boxes(spark, d, ZONE))


@query
def dissolve_layer(spark, d):
    pieces = overlay.dissolve(boxes(spark, d, ZONE))
    return pieces.agg(F.sum("area").alias("area"), F.min("x0").alias("x0"), F.max("y1").alias("y1"))


@query
def within_union(spark, d):
    return overlay.within_union(boxes(spark, d, LAND), boxes(spark, d, ZONE)).select("id")


@query
def buffer_zones(spark, d):
    zones = overlay.zone(lines(spark, d), 200.0)
    areas = overlay.shape_areas(zones).select(F.col("id").alias("_id"), F.round("area", 2).alias("area"))
    return zones.join(areas, F.col("id") == F.col("_id")).select("id", "x0", "y0", "x1", "y1", "area")


def _corners(shape):
    """The corners of all rings in sorted order, as whole numbers."""
    open_ = F.transform(shape["parts"], lambda r: F.slice(r, F.lit(1), F.size(r) - 1))
    whole = F.transform(F.flatten(open_), lambda p: F.struct(F.round(p["x"]).cast("long").alias("x"), F.round(p["y"]).cast("long").alias("y")))
    return F.array_join(F.transform(F.array_sort(whole), lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ";").alias("corners")


@query
def clip_polygons(spark, d):
    out = overlay.clip_polygons(turned(boxes(spark, d, LAND)), turned(boxes(spark, d, ZONE)))
    return out.select("id", F.round("clip_area", 3).alias("clip_area"), _corners(F.col("shape")))


@query
def erase_polygons(spark, d):
    out = overlay.erase_polygons(turned(boxes(spark, d, LAND)), turned(boxes(spark, d, ZONE)))
    return out.select("id", F.round("erase_area", 3).alias("erase_area"), _corners(F.col("shape")))


@query
def holes_clip(spark, d):
    out = overlay.clip_polygons(turned(boxes(spark, d, LAND)), turned(holed(boxes(spark, d, ZONE))))
    return out.select("id", F.round("clip_area", 3).alias("clip_area"), _corners(F.col("shape")))


@query
def intersection_polygons(spark, d):
    out = overlay.intersection_polygons(turned(boxes(spark, d, LAND)), turned(boxes(spark, d, ZONE)))
    return out.select("left_id", "right_id", F.round("area", 3).alias("area"), _corners(F.col("shape")))


@query
def dissolve_polygons(spark, d):
    out = overlay.dissolve_polygons(turned(boxes(spark, d, ZONE)))
    return out.select(F.round("area", 3).alias("area"), _corners(F.col("shape")))


@query
def union_outline(spark, d):
    out = overlay.dissolve_polygons(turned(boxes(spark, d, LAND)), turned(boxes(spark, d, ZONE)))
    open_ = F.transform(F.col("shape.parts"), lambda r: F.slice(r, F.lit(1), F.size(r) - 1))
    spots = out.select(F.inline(F.flatten(open_)))
    return spots.groupBy(F.round("x").cast("long").alias("x"), F.round("y").cast("long").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query
def turned_union(spark, d):
    out = overlay.union_area(turned(boxes(spark, d, LAND)), turned(boxes(spark, d, ZONE)))
    return out.select(F.round("area", 2).alias("area"))


@query
def turned_within(spark, d):
    return overlay.within_union(turned(boxes(spark, d, LAND)), turned(boxes(spark, d, ZONE))).select("id")


@query
def turned_overlaps(spark, d):
    out = overlay.overlap_pairs(turned(boxes(spark, d, LAND)))
    return out.select("a", "b", F.round("area", 3).alias("area"))


@query
def points_within(spark, d):
    spots = derive(spark, d, SPOT).withColumns({"x0": F.col("x0") - F.col("y0"), "y0": F.col("x0") + F.col("y0")})
    return overlay.points_within(spots, turned(boxes(spark, d, ZONE))).select("id")


@query
def even_points(spark, d):
    """Random points in the zones, by columns of 1 km: all inside, and in every stretch the share that its area asks for."""
    zones, n = turned(boxes(spark, d, ZONE)), 500
    points = scatter.random_points(zones, n, size=1000.0).select("id", *[F.col(c[0]).alias(c) for c in ("x0", "y0", "x1", "y1")])
    points = checkpointed(points.withColumn("shape", shapes.point_shape(F.col("x0"), F.col("y0"))))
    held = grid.matched_keys(points, zones).withColumn("held", F.lit(1))
    column = F.floor(F.col("x0") / 1000).alias("cx")
    found = points.join(held, "id", "left").groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.count("held").alias("held"))
    areas = overlay.dissolve(zones, size=1000.0).groupBy(column).agg(F.sum("area").alias("area"))
    rows = areas.join(found, "cx", "left")
    upto = Window.orderBy("cx")  # one row per column of the extent
    whole = Window.partitionBy()
    off = F.sum(F.coalesce("n", F.lit(0))).over(upto) - n * F.sum("area").over(upto) / F.sum("area").over(whole)
    return rows.select(
        "cx", F.round("area", 2).alias("area"), (F.abs(off) <= 1 + 1e-6).alias("even"), F.col("n").eqNullSafe(F.col("held")).alias("all_inside"),
        F.sum("n").over(whole).alias("points"),
    )


@query
def invalid_polygons(spark, d):
    return validity.invalid_polygons(flawed(boxes(spark, d, LAND)))


@query
def zone_clip(spark, d):
    out = overlay.clip_polygons(boxes(spark, d, LAND), overlay.zone(long_roads(spark, d), 200.0))
    return out.select("id", F.round("clip_area", 2).alias("clip_area"))


@query
def zone_erase(spark, d):
    out = overlay.erase(boxes(spark, d, LAND), overlay.zone(long_roads(spark, d), 200.0))
    return out.select("id", F.round("erase_area", 2).alias("erase_area"))


@query
def zone_intersection(spark, d):
    out = overlay.intersection(boxes(spark, d, LAND), overlay.zone_polygons(long_roads(spark, d), 200.0))
    return out.select("left_id", "right_id", F.round("area", 2).alias("area"))


@query
def zone_polygons(spark, d):
    out = overlay.zone_polygons(long_roads(spark, d), 200.0)
    corners = F.size(F.flatten("shape.parts")) - F.size("shape.parts")
    return out.select("id", F.round("zone_area", 2).alias("zone_area"), F.size("shape.parts").alias("rings"), corners.alias("corners"))


@query
def zone_members(spark, d):
    return nearest.within_distance(boxes(spark, d, LAND), lines(spark, d), 200.0)


@query
def near_line(spark, d):
    out = nearest.nearest_distance(boxes(spark, d, LAND), lines(spark, d))
    return out.select("id", F.round("distance_m", 6).alias("distance_m"))


@query
def distance_stats(spark, d):
    out = nearest.distance_stats(nearest.nearest_distance(boxes(spark, d, HOUSE), lines(spark, d)))
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


PLACES = """select p_partkey id, 19.05e0 + (p_partkey*7919%1300)/1000e0 lon,
  44.73e0 + (p_partkey*104729%520)/1000e0 lat from {part}"""


@query
def utm_points(spark, d):
    p = derive(spark, d, PLACES).withColumn("u", geodesy.to_utm(F.col("lon"), F.col("lat")))
    back = geodesy.from_utm(F.col("u.x"), F.col("u.y"))
    off = F.greatest(F.abs(back["x"] - F.col("lon")), F.abs(back["y"] - F.col("lat")))
    return p.select("id", F.round("u.x", 2).alias("easting"), F.round("u.y", 2).alias("northing"), (off < 1e-8).alias("round_trip"))


@query
def geojson_lines(spark, d):
    return export.geojson_lines(boxes(spark, d, LAND))


@query
def thin_layer(spark, d):
    moved = boxes(spark, d, LAND).withColumn("shape", shapes.map_points(F.col("shape"), lambda p: shapes.point(p["x"] + 3, p["y"] - 4)))
    return export.thin(moved, 10.0).select("id", "x0", "y0", "x1", "y1", shapes.area(F.col("shape")).alias("area"))


# ---- scenes -----------------------------------------------------------------------

SCENES = "select distinct scene_id, cloud from (" + OBS + ") o"


def _pixels(spark, d):
    found = scenes.filter_scenes(derive(spark, d, SCENES), window=None, season=None)
    return scenes.pixels_of(derive(spark, d, OBS), found)


@query
def scene_filter(spark, d):
    dated = derive(spark, d, "select scene_id, cloud, min(ts) ts from (" + OBS + ") o group by scene_id, cloud")
    out = scenes.filter_scenes(dated, window=None, season=("1996-04-01", "1999-09-30"), cloud_limit=50.0)
    return out.select("scene_id", "cloud", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


TILES = """select scene_id, cloud, floor(x/5000) tx, floor(y/5000) ty, min(ts) ts, min(x) x0, min(y) y0, max(x) x1, max(y) y1
  from (""" + OBS + """) o group by scene_id, cloud, floor(x/5000), floor(y/5000)"""


@query
def scene_window(spark, d):
    out = scenes.filter_scenes(derive(spark, d, TILES), window=(12345.0, 6789.0, 23456.0, 17890.0), season=("1994-01-01", "1999-09-30"), cloud_limit=60.0)
    return out.select("scene_id", F.col("tx").cast("long").alias("tx"), F.col("ty").cast("long").alias("ty"), "x0", "y0", "x1", "y1")


@query
def ndvi_rows(spark, d):
    return scenes.with_ndvi(_pixels(spark, d)).select("pixel_id", "scene_id", "red", "nir", "ndvi")


@query
def median_composite(spark, d):
    return scenes.median_composite(_pixels(spark, d))


@query
def median_ndvi(spark, d):
    return scenes.median_ndvi(_pixels(spark, d))


@query
def best_scene(spark, d):
    obs = derive(spark, d, OBS)
    return scenes.best_scene_ndvi(obs, derive(spark, d, SCENES)).select("pixel_id", "scene_id", "ndvi")


@query
def clearest_pixels(spark, d):
    return scenes.clearest_pixels(derive(spark, d, OBS))


@query
def point_values(spark, d):
    points = derive(spark, d, "select c_custkey id, (c_custkey*6151)%40000 x, (c_custkey*50021)%31000 y from {customer}")
    out = scenes.sample_at_points(points, derive(spark, d, OBS), ["red", "nir"], 1000.0)
    return out.select("id", F.round("red", 9).alias("red"), F.round("nir", 9).alias("nir"))


@query
def weather_cells(spark, d):
    m = scenes.weather_means(derive(spark, d, WEATHER))
    return m.select("cx", "cy", F.round("temperature_2m", 6).alias("temperature_2m"), F.round("total_precipitation", 9).alias("total_precipitation"))


@query
def raster_profile(spark, d):
    return scenes.raster_profile(scenes.with_ndvi(derive(spark, d, OBS)))


def _samples(spark, d):
    at = derive(spark, d, "select p_partkey sample_id, (p_partkey*7919)%40000 x, (p_partkey*104729)%31000 y from {part}")
    med = scenes.median_composite(_pixels(spark, d))
    return at.join(med, F.col("sample_id") == F.col("pixel_id")).drop("pixel_id")


def _training(spark, d):
    return crops.training_frame(_samples(spark, d), scenes.weather_means(derive(spark, d, WEATHER)))


@query
def feature_frame(spark, d):
    full = crops.clipped(crops.feature_frame(_samples(spark, d), scenes.weather_means(derive(spark, d, WEATHER))))
    return full.select("sample_id", *[F.round(c, 6).alias(c) for c in crops.FEATURES])


@query
def feature_gaps(spark, d):
    """Pixels that lack bands or indices, and a column of weather cells that never reports."""
    gap = lambda c, n: F.when(F.col("sample_id") % n != 0, F.col(c))
    samples = _samples(spark, d).withColumns({"red": gap("red", 7), "ndwi": gap("ndwi", 5), "savi": gap("savi", 3)})
    weather = scenes.weather_means(derive(spark, d, WEATHER).where("cx <> 1"))
    full = crops.clipped(crops.feature_frame(samples, weather))
    return full.select("sample_id", *[F.round(c, 6).alias(c) for c in crops.FEATURES])


@query
def rule_labels(spark, d):
    return _training(spark, d).select("sample_id", "crop_type")


# ---- model ------------------------------------------------------------------------

PREDICTED = """select l_orderkey sample_id, l_returnflag crop_type,
  case when l_quantity < 30 then l_returnflag when l_linestatus = 'O' then 'R' else 'X' end predicted from {lineitem}"""
FOUND = """select l_returnflag crop_type, l_quantity area_ha, l_discount*10 ndvi_mean, l_tax*100 confidence from {lineitem}"""


@query
def strat_split(spark, d):
    vecs = derive(spark, d, "select o_orderkey vec_id, o_orderpriority label from {orders}")
    return sampling.stratified_split(vecs, "label", "vec_id").select("vec_id", "label", "is_test")


@query
def strat_split_sizes(spark, d):
    vecs = table(spark, d, "embeddings").select("vec_id", "label")
    s = sampling.stratified_split(vecs, "label", "vec_id")
    return s.groupBy("label").agg(F.count_if("is_test").alias("test"), F.count_if(~F.col("is_test")).alias("train"))


@query
def class_metrics(spark, d):
    return crops.class_metrics(derive(spark, d, PREDICTED))


@query
def accuracy(spark, d):
    return crops.accuracy(derive(spark, d, PREDICTED))


@query
def class_stats(spark, d):
    return crops.class_stats(derive(spark, d, FOUND))


@query
def class_counts(spark, d):
    return crops.class_counts(derive(spark, d, FOUND))


def _model(spark, d):
    train, test = crops.split(_training(spark, d))
    return crops.train(train), test


@query
def forest_scores(spark, d):
    model, test = _model(spark, d)
    return crops.score(model, test)


@query
def importances(spark, d):
    return crops.importances(spark, _model(spark, d)[0])


@query
def model_checks(spark, d):
    """One forest fitted, saved, loaded and scored with both: sizes, and how often a promise is broken."""
    train, test = (checkpointed(f) for f in crops.split(_training(spark, d)))
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    made = crops.load_or_train(spark, path, train)
    loaded = crops.load_or_train(spark, path, train.where("false"))  # nothing could be fitted on no rows
    again = crops.score(loaded, test).select(F.col("sample_id").alias("_id"), F.col("predicted").alias("_class"), F.col("probability").alias("_p"))
    both = crops.score(made, test).join(again, F.col("sample_id") == F.col("_id"), "left")
    classes = train.select(F.collect_set("crop_type")).scalar()
    weights = crops.importances(spark, made)
    one = weights.select((F.abs(F.sum("importance") - 1) < 1e-9) & (F.min("importance") >= 0) & (F.count_distinct("feature") == 7)).scalar()
    return both.agg(
        F.count(F.lit(1)).alias("test_rows"), F.max(F.size(classes)).cast("long").alias("classes"),
        F.count_if((F.col("predicted") == F.col("_class")) & (F.abs(F.col("probability") - F.col("_p")) < 1e-12)).alias("same_after_reload"),
        F.count_if((F.col("probability") > 1 / F.size(classes) - 1e-9) & (F.col("probability") < 1 + 1e-9)).alias("probable"),
        F.count_if(F.array_contains(classes, F.col("predicted"))).alias("known_class"), F.max(one).alias("importances_add_up"),
    )


SCORED = """select p_partkey sample_id, 19.05e0 + (p_partkey*7919%1300)/1000e0 longitude,
  44.73e0 + (p_partkey*104729%520)/1000e0 latitude, p_size/50e0 ndvi, 20e0 temperature, 60e0 humidity,
  p_size/64e0 probability, case when p_size < 20 then 'Soja' when p_size < 40 then 'Kukuruz' else 'Trava' end predicted
  from {part}"""


@query
def detections_saved(spark, d):
    """Two versions of the stored detections: the second batch repeats ids and replaces rows of the first."""
    found = crops.detections(derive(spark, d, SCORED))
    folder = f"{shared_folder(spark)}/detections-{uuid.uuid4().hex}"
    second = found.where("detection_id % 3 > 0").withColumn("confidence", F.lit(1.5).cast("decimal(5,1)"))
    crops.save_detections(spark, found.where("detection_id % 3 < 2"), folder, "first")
    out = shapes.with_bounds(crops.save_detections(spark, second.unionByName(second), folder, "second", "first"))
    box = [F.round(c, 9).alias(c) for c in ("x0", "y0", "x1", "y1")]
    return _dbl(out, "confidence", "area_ha").select("detection_id", "crop_type", "confidence", "area_ha", "color", *box)


DEGREES = """select id, 19.05e0 + x0/32000e0 x0, 19.05e0 + x1/32000e0 x1, 44.73e0 + y0/62200e0 y0, 44.73e0 + y1/62200e0 y1
  from (""" + LAND + ") k"
PLACED = "select p_partkey detection_id, (p_partkey*7919)%40000 x0, (p_partkey*104729)%31000 y0 from {part}"


@query
def detection_report(spark, d):
    """All parts of the report as rows: classes, landuse of every detection, how many have one, distances to roads."""
    found = crops.detections(derive(spark, d, SCORED))
    spots = derive(spark, d, PLACED).withColumn("shape", shapes.point_shape(F.col("x0"), F.col("y0")))
    report = crops.detection_report(found, {"landuse": boxes(spark, d, DEGREES), "roads": lines(spark, d)}, shapes.with_bounds(spots))

    def rows(part, text, first, second, value):
        return report[part].select(F.lit(part).alias("part"), *[c.cast(t).alias(n) for c, t, n in (
            (text, "string", "label"), (first, "long", "a"), (second, "long", "b"), (F.round(value, 4), "double", "value"))])

    c, none = F.col, F.lit(0)
    return (
        rows("class_stats", c("crop_type"), c("n"), none, c("mean_confidence"))
        .unionByName(rows("landuse_overlap", c("crop_type"), c("detection_id"), c("id"), none))
        .unionByName(rows("landuse_matched", F.lit(""), c("matched"), c("total"), none))
        .unionByName(rows("road_distance", F.lit(""), c("detection_id"), none, c("road_distance_m")))
        .unionByName(rows("road_distance_stats", F.lit(""), none, none, c("mean_m")))
    )


@query
def detections(spark, d):
    """Detection records over given scores: quantities of the order lines stand in for the model's output."""
    out = crops.detections(derive(spark, d, SCORED)).drop("created_at", "shape")
    return _dbl(out, "confidence", "ndvi_mean", "lai_estimate", "area_ha", "latitude", "longitude", "temperature", "humidity")


EDITS = """select o_custkey detection_id, o_orderkey seq,
  case o_orderstatus when 'F' then 'confidence' when 'O' then 'crop_type' else 'colour' end attribute,
  case when o_orderpriority = '5-LOW' then 'low' else cast(o_orderkey%100 as string) end value from {orders}"""


@query
def edit_detections(spark, d):
    base = derive(spark, d, "select c_custkey detection_id, c_mktsegment crop_type, cast(50.0 as decimal(5,1)) confidence from {customer}")
    edited, _, _ = crops.edit_attributes(base, derive(spark, d, EDITS))
    return _dbl(edited, "confidence")


@query
def rejected_edits(spark, d):
    base = derive(spark, d, "select c_custkey detection_id, c_mktsegment crop_type, cast(50.0 as decimal(5,1)) confidence from {customer}")
    _, rejected, _ = crops.edit_attributes(base, derive(spark, d, EDITS))
    return rejected.groupBy("reason").agg(F.count("*").alias("n"))
