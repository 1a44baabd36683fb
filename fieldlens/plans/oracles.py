"""The checking SQL for the queries of ``catalog``: plain statements, no spatial functions."""

from __future__ import annotations

from math import pi, sin

from fieldlens.functions import geodesy as g
from fieldlens.plans import catalog as c
from fieldlens.plans import derived as dv
from fieldlens.sources.layers import LANDUSE_CATEGORY


def _sql(text: str) -> str:
    for name in dv.TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def _with(**texts: str) -> str:
    return "with " + ", ".join(f"{n} as ({_sql(t)})" for n, t in texts.items()) + " "


ORACLE: dict[str, str] = {}


def _mix(key: str, seed: int = 42) -> str:
    """The scatter of ``spectral.mix`` for keys from 0 to 2^31."""
    first = f"((({key})::bigint % 2147483647 * 48271 + {seed * 7919 + 1}) % 2147483647)"
    return f"(({first} * {first} % 2147483629 * 69621 + {first}) % 2147483629)"


ORACLE["join_range"] = _with(p=c.PARCEL_OF_LINE, s=c.SOIL) + """
select p.number, p.area_ha::double area_ha, s.name soil_name, s.ph::double ph from p join s on p.soil_id = s.id
where s.ph between 10 and 20"""
ORACLE["join_three"] = _with(c=c.CROP_OF_LINE, p=c.PARCEL_OF_ORDER, o=c.OWNER) + """
select c.name crop_name, c.variety, p.number, o.first_name, o.last_name, o.kind owner_kind
from c join p on c.parcel_id = p.id join o on p.owner_id = o.id where c.status = 'aktivan'"""
ORACLE["join_measure"] = _with(m=c.MONITORING_OF_LINE, c=c.CROP_OF_ORDER) + """
select c.name crop_name, m.day::varchar as day, m.ndvi::double ndvi, m.health, m.problems from m join c on m.crop_id = c.id
where m.ndvi < 0.5"""
ORACLE["join_left"] = _with(p=c.PARCEL_OF_CUSTOMER, m=c.MUNICIPALITY, c=c.CROP_OF_ORDER) + """
select m.name municipality_name, m.district, p.number, c.name crop_name, c.status from p join m on p.municipality_id = m.id
left join c on p.id = c.parcel_id where m.district = 'ASIA'"""
ORACLE["owner_totals"] = _with(o=c.OWNER, p=c.PARCEL_OF_ORDER) + """
select o.id, o.first_name, o.last_name, o.kind owner_kind, count(p.id) parcels, sum(p.area_ha)::double total_area_ha
from o join p on o.id = p.owner_id group by all having sum(p.area_ha) > 1000000"""
ORACLE["star_five"] = _with(c=c.CROP_OF_LINE, p=c.PARCEL_FULL, s=c.SOIL, o=c.OWNER, m=c.MUNICIPALITY) + """
select c.name crop_name, s.name soil_name, s.drainage, o.first_name owner_name, o.email, m.name municipality_name
from c join p on c.parcel_id = p.id join s on p.soil_id = s.id join o on p.owner_id = o.id
join m on p.municipality_id = m.id where c.irrigated"""
ORACLE["chain_four"] = _with(n=c.MONITORING_OF_LINE, c=c.CROP_OF_ORDER, p=c.PARCEL_OF_CUSTOMER, m=c.MUNICIPALITY) + """
select n.day::varchar as day, n.operator, n.treatment, c.name crop_name, c.variety, p.number, p.address parcel_address, m.town
from n join c on n.crop_id = c.id join p on c.parcel_id = p.id join m on p.municipality_id = m.id
where n.treatment is not null and n.treatment <> '—'"""

ORACLE["change_insert"] = _with(n=c.NEW_CUSTOMERS) + """
select * from customer union all select c_custkey, c_name, c_nationkey, 0.0, 'NEW' from n"""
ORACLE["change_update"] = _with(b=c.BALANCES) + """, l as (select *, row_number() over
(partition by c_custkey order by seq desc, c_acctbal desc) r from b)
select c.c_custkey, c.c_name, c.c_nationkey, case when l.c_custkey is null then c.c_acctbal else l.c_acctbal end c_acctbal,
c.c_mktsegment from customer c left join l on c.c_custkey = l.c_custkey and l.r = 1"""
ORACLE["change_delete"] = _with(k=c.POOR) + """
select * from customer where not exists (select 1 from k where s_suppkey = c_nationkey)"""
ORACLE["change_upsert"] = _with(b=c.MIXED) + """, l as (select *, row_number() over (partition by c_custkey order by seq desc) r from b)
select c.* from customer c where c.c_custkey not in (select c_custkey from l)
union all select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from l
where r = 1 and (action = 'insert' or (action = 'update' and c_custkey in (select c_custkey from customer)))"""
ORACLE["update_one"] = """select c_custkey, c_name, c_nationkey, c_acctbal,
case when c_nationkey = 3 then 'MOVED' else c_mktsegment end c_mktsegment from customer"""
ORACLE["delete_one"] = "select * from customer where c_mktsegment is distinct from 'BUILDING'"
ORACLE["affected_rows"] = "select count(*) affected from customer where c_mktsegment = 'BUILDING'"
ORACLE["cascade_delete"] = """with n as (select n_nationkey from nation join region on n_regionkey = r_regionkey
where r_name <> 'ASIA'),
c as (select * from customer where c_nationkey in (select * from n)),
o as (select * from orders where o_custkey not in (select c_custkey from customer where c_nationkey not in (select * from n))),
l as (select * from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderkey not in (select o_orderkey from o)))
select 'nation' table_name, count(*) as rows, sum(n_nationkey)::bigint key_sum from n
union all select 'customer', count(*), sum(c_custkey)::bigint from c
union all select 'orders', count(*), sum(o_orderkey)::bigint from o
union all select 'lineitem', count(*), sum(l_partkey)::bigint from l"""
ORACLE["setnull_delete"] = _with(k=c.POOR) + """
select case when l_suppkey in (select s_suppkey from k) then null else l_suppkey end l_suppkey, count(*) as rows
from lineitem group by 1"""
ORACLE["integrity_report"] = """with c as (select * from customer),
o as (select * from orders union all select * replace (-o_orderkey as o_orderkey, -o_custkey as o_custkey) from orders where o_orderstatus = 'P')
select 'nation' table_name, 'not_null' check_name, 'n_nationkey' column_name, count(*) violations from nation where n_nationkey is null
union all select 'nation', 'not_null', 'n_name', count(*) from nation where n_name is null
union all select 'nation', 'max_length', 'n_name', count(*) from nation where length(n_name) > 8
union all select 'nation', 'unique', 'n_nationkey', count(*) from (select 1 from nation group by n_nationkey having count(*) > 1)
union all select 'nation', 'unique', 'n_name', count(*) from (select 1 from nation group by n_name having count(*) > 1)
union all select 'customer', 'not_null', 'c_custkey', count(*) from c where c_custkey is null
union all select 'customer', 'not_null', 'c_name', count(*) from c where c_name is null
union all select 'customer', 'max_length', 'c_name', count(*) from c where length(c_name) > 17
union all select 'customer', 'max_length', 'c_mktsegment', count(*) from c where length(c_mktsegment) > 9
union all select 'customer', 'unique', 'c_custkey', count(*) from (select 1 from c group by c_custkey having count(*) > 1)
union all select 'customer', 'unique', 'c_acctbal', count(*) from (select 1 from c where c_acctbal is not null group by c_acctbal having count(*) > 1)
union all select 'orders', 'not_null', 'o_orderkey', count(*) from o where o_orderkey is null
union all select 'orders', 'not_null', 'o_custkey', count(*) from o where o_custkey is null
union all select 'orders', 'precision', 'o_totalprice', count(*) from o where o_totalprice >= 99999.995
union all select 'orders', 'not_null', 'o_orderpriority', count(*) from o where o_orderpriority is null
union all select 'orders', 'max_length', 'o_orderpriority', count(*) from o where length(o_orderpriority) > 10
union all select 'orders', 'unique', 'o_orderkey', count(*) from (select 1 from o group by o_orderkey having count(*) > 1)
union all select 'orders', 'unique', 'o_totalprice', count(*) from (select 1 from o group by o_totalprice having count(*) > 1)
union all select 'supplier', 'not_null', 's_suppkey', count(*) from supplier where s_suppkey is null
union all select 'supplier', 'not_null', 's_name', count(*) from supplier where s_name is null
union all select 'supplier', 'max_length', 's_name', count(*) from supplier where length(s_name) > 17
union all select 'supplier', 'unique', 's_suppkey', count(*) from (select 1 from supplier group by s_suppkey having count(*) > 1)
union all select 'lineitem', 'not_null', 'l_orderkey', count(*) from lineitem where l_orderkey is null
union all select 'lineitem', 'unique', 'l_orderkey', count(*) from (select 1 from lineitem group by l_orderkey having count(*) > 1)
union all select 'customer', 'foreign_key', 'c_nationkey', count(*) from c where c_nationkey not in (select n_nationkey from nation)
union all select 'orders', 'foreign_key', 'o_custkey', count(*) from o where o_custkey not in (select c_custkey from c)
union all select 'lineitem', 'foreign_key', 'l_orderkey', count(*) from lineitem where l_orderkey not in (select o_orderkey from o)
union all select 'lineitem', 'foreign_key', 'l_suppkey', count(*) from lineitem where l_suppkey not in (select s_suppkey from supplier)"""

_CATEGORY = "case fclass " + " ".join(f"when '{k}' then '{v}'" for k, v in LANDUSE_CATEGORY.items()) + " else fclass end"
ORACLE["class_map"] = _with(k=c.CLASSED) + f"select id, fclass, fclass as type, {_CATEGORY} category from k"
ORACLE["enrich_roads"] = _with(k=c.CLASSED) + "select id, fclass, fclass as type, 'road' category, fclass highway from k"
ORACLE["region_filter"] = _with(a=dv.LAND) + "select * from a where x0 <= 20000 and x1 >= 10000 and y0 <= 15000 and y1 >= 5000"
ORACLE["layer_profile"] = """select 'landuse' layer, count(*) features, 32634 srid, 'polygon' kinds, 'id' as columns from part
union all select 'roads', count(*), 32634, 'line', 'id' from supplier"""
ORACLE["table_profile"] = """select 'nation' table_name, count(*) row_count, 'n_nationkey,n_name,n_regionkey' as columns from nation
union all select 'customer', count(*), 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' from customer
union all select 'orders', count(*), 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' from orders
union all select 'lineitem', count(*), 'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate' from lineitem"""
ORACLE["sample_n"] = _with(a=dv.LAND) + f"select * from a order by {_mix('id')}, id limit 500"
ORACLE["present_rows"] = """select o_orderkey::varchar o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') o_orderdate,
coalesce(nullif(o_orderstatus, 'F'), '') status from orders"""
ORACLE["complete_cases"] = "select event_id, event_type, user_id from events where event_type <> 'error' and user_id is not null and event_id is not null"
ORACLE["summary"] = """select 'table_rows' metric, 'nation' as name, count(*) as value from nation
union all select 'table_rows', 'customer', count(*) from customer union all select 'detections', 'all', count(*) from lineitem
union all select 'detected_class', l_returnflag, count(*) from lineitem group by l_returnflag
union all select 'layer', 'landuse', 1 union all select 'layer', 'roads', 1
union all select 'overlay_results', 'all', 1 union all select 'register_queries', 'all', 7"""

_MEET = "a.x0 <= b.x1 and a.x1 >= b.x0 and a.y0 <= b.y1 and a.y1 >= b.y0"
_COMMON = "(greatest(least(a.x1,b.x1)-greatest(a.x0,b.x0),0)*greatest(least(a.y1,b.y1)-greatest(a.y0,b.y0),0))::double"
_GAP2 = "pow(greatest(a.x0-b.x1,b.x0-a.x1,0),2)+pow(greatest(a.y0-b.y1,b.y0-a.y1,0),2)"
_ab = lambda a, b: _with(a=a, b=b)
ORACLE["spatial_pairs"] = _ab(dv.FIELD, dv.HOUSE) + f"select a.id id_a, b.id id_b from a, b where {_MEET}"
ORACLE["spatial_left"] = _ab(dv.HOUSE, dv.FIELD) + f"select a.id id_a, b.id id_b, a.x0 x0_a, b.x0::double x0_b from a left join b on {_MEET}"
ORACLE["exact_pairs"] = _ab(dv.LAND, dv.ZONE) + f"select a.id id_a, b.id id_b from a, b where {_MEET}"
ORACLE["dense_pairs"] = ORACLE["exact_pairs"]
ORACLE["dense_left"] = _ab(dv.ZONE, dv.HOUSE) + f"select a.id id_a, b.id id_b from a left join b on {_MEET}"
ORACLE["unique_matches"] = _ab(dv.FIELD, dv.HOUSE) + f"select count(distinct a.id) matched, (select count(*) from a) total from a, b where {_MEET}"
ORACLE["touching_pairs"] = _ab(dv.LAND, dv.ZONE) + f"""select a.id a, b.id b, 'landuse_' || a.id left_name,
'natural_' || b.id right_name, {_COMMON} area from a, b where {_MEET}"""
ORACLE["overlap_pairs"] = _ab(dv.LAND, dv.LAND) + f"""select a.id a, b.id b, {_COMMON} area from a, b where a.id < b.id
and {_COMMON} > 0 and {_COMMON} < (a.x1-a.x0)*(a.y1-a.y0) and {_COMMON} < (b.x1-b.x0)*(b.y1-b.y0)"""
ORACLE["pair_areas"] = _ab(dv.LAND, dv.ZONE) + f"select a.id a, b.id b, {_COMMON} area from a, b where {_COMMON} > 0"
ORACLE["intersection_overlay"] = _ab(dv.LAND, dv.ZONE) + f"""select a.id left_id, p_type left_fclass, b.id right_id, s_name right_name,
{_COMMON} area from a, b, part, supplier where p_partkey = a.id and s_suppkey = b.id and {_COMMON} > 0"""

_CELLS = lambda n: f"""(select id, cx, unnest(generate_series(y0//100, y1//100-1)) cy from
(select *, unnest(generate_series(x0//100, x1//100-1)) cx from {n}))"""  # noqa: E731
_CLIPPED = f""", z as (select distinct cx, cy from {_CELLS('b')}), i as (select id, count(*) n from {_CELLS('a')} join z using (cx, cy) group by id)"""
ORACLE["clip_area"] = _ab(dv.LAND, dv.ZONE) + _CLIPPED.lstrip() + f"""
select a.id, coalesce(i.n, 0)*10000.0::double clip_area, i.n is null touch_only from a left join i using (id)
where exists (select 1 from b where {_MEET})"""
ORACLE["erase_area"] = _ab(dv.LAND, dv.ZONE) + _CLIPPED.lstrip() + """
select a.id, ((x1-x0)*(y1-y0) - coalesce(i.n, 0)*10000)::double erase_area from a left join i using (id)
where (x1-x0)*(y1-y0) > coalesce(i.n, 0)*10000"""
ORACLE["within_union"] = _ab(dv.LAND, dv.ZONE) + _CLIPPED.lstrip() + """
select a.id from a join i using (id) where (x1-x0)*(y1-y0) = i.n*10000"""
ORACLE["union_area"] = _ab(dv.LAND, dv.ZONE) + f"""
select (count(*)*10000)::double area from (select cx, cy from {_CELLS('a')} union select cx, cy from {_CELLS('b')})"""
ORACLE["dissolve_layer"] = _with(b=dv.ZONE) + f"""select (count(distinct (cx, cy))*10000)::double area,
(min(cx)*100)::double x0, (max(cy)*100+100)::double y1 from {_CELLS('b')}"""
_CAPSULE = 2000 * 400 + 0.5 * 64 * 200**2 * sin(2 * pi / 64)
ORACLE["buffer_zones"] = _with(b=dv.LINE) + f"""select id, x0-200::double x0, y0-200::double y0, x1+200::double x1, y1+200::double y1,
{round(_CAPSULE, 2)}::double area from b"""
ORACLE["zone_members"] = _ab(dv.LAND, dv.LINE) + f"select a.id a, b.id b from a, b where {_GAP2} <= 200*200"
ORACLE["near_line"] = _ab(dv.LAND, dv.LINE) + f"select a.id, round(sqrt(min({_GAP2})), 6) distance_m from a, b group by a.id"
ORACLE["distance_stats"] = _ab(dv.HOUSE, dv.LINE) + f""", n as (select a.id, sqrt(min({_GAP2})) d from a, b group by a.id)
select round(min(d), 4) min_m, round(max(d), 4) max_m, round(avg(d), 4) mean_m from n"""

# Turned layers: corners of 100 m cells by the cells that meet there (1 right above, 2 left above, 4 left below, 8 right
# below); an odd number of them is a corner, two across from each other are two, and everything moves to (x - y, x + y).
_CORNERS = lambda keys, cells: f""", k as ({cells}), v(dx, dy, bit) as (values (0, 0, 1), (1, 0, 2), (1, 1, 4), (0, 1, 8)),
  m as (select {keys}, cx + dx px, cy + dy py, sum(bit) b from k, v group by all),
  e as (select {keys}, (px - py) * 100 x, (px + py) * 100 y, unnest(range(case when b in (5, 10) then 2 when b in (1, 2, 4, 8, 7, 11, 13, 14) then 1 else 0 end)) from m),
  c as (select {keys}, string_agg(x || ' ' || y, ';' order by x, y) corners from e group by {keys}),
  s as (select {keys}, count(*) * 20000.0::double area from k group by {keys})"""  # noqa: E731
_Z = ", z as (select distinct cx, cy from " + _CELLS("b") + ")"
ORACLE["clip_polygons"] = _ab(dv.LAND, dv.ZONE) + _Z + _CORNERS("id", f"select distinct id, cx, cy from {_CELLS('a')} join z using (cx, cy)") + " select id, area clip_area, corners from s join c using (id)"
ORACLE["erase_polygons"] = _ab(dv.LAND, dv.ZONE) + _Z + _CORNERS("id", f"select distinct id, cx, cy from {_CELLS('a')} anti join z using (cx, cy)") + " select id, area erase_area, corners from s join c using (id)"
_RIM = ", h as (select id, x0 + 100 x0, y0 + 100 y0, x1 - 100 x1, y1 - 100 y1 from b), z as (select distinct cx, cy from " + _CELLS("b") + " anti join " + _CELLS("h") + " using (id, cx, cy))"
ORACLE["holes_clip"] = _ab(dv.LAND, dv.ZONE) + _RIM + _CORNERS("id", f"select distinct id, cx, cy from {_CELLS('a')} join z using (cx, cy)") + " select id, area clip_area, corners from s join c using (id)"
ORACLE["intersection_polygons"] = _ab(dv.LAND, dv.ZONE) + f""", p as (select a.id left_id, b.id right_id, 2*{_COMMON} area,
  greatest(a.x0, b.x0) u0, least(a.x1, b.x1) u1, greatest(a.y0, b.y0) v0, least(a.y1, b.y1) v1 from a, b where {_COMMON} > 0),
e as (select left_id, right_id, area, unnest([u0 - v0, u1 - v0, u1 - v1, u0 - v1]) x, unnest([u0 + v0, u1 + v0, u1 + v1, u0 + v1]) y from p)
select left_id, right_id, area, string_agg(x || ' ' || y, ';' order by x, y) corners from e group by all"""
_SIDE = "a.x0 <= b.x1 and a.x1 >= b.x0 and a.y0 <= b.y1 and a.y1 >= b.y0 and (a.x0 < b.x1 and a.x1 > b.x0 or a.y0 < b.y1 and a.y1 > b.y0)"
ORACLE["dissolve_polygons"] = _with(b=dv.ZONE).replace("with ", "with recursive ", 1) + f""", r(id, part) as (select id, id from b union
  select b.id, r.part from r join b a on a.id = r.id join b on {_SIDE}),
p as (select id, min(part) part from r group by id)""" + _CORNERS("part", f"select distinct part, cx, cy from {_CELLS('b')} join p using (id)") + " select area, corners from s join c using (part)"
ORACLE["union_outline"] = _ab(dv.LAND, dv.ZONE) + _CORNERS("o", f"select 1 o, cx, cy from (select cx, cy from {_CELLS('a')} union select cx, cy from {_CELLS('b')})") + " select x, y, count(*) n from e group by x, y"
ORACLE["turned_union"] = ORACLE["union_area"].replace("count(*)*10000", "count(*)*20000")
ORACLE["turned_within"] = ORACLE["within_union"]
ORACLE["turned_overlaps"] = f"select a, b, 2*area area from ({ORACLE['overlap_pairs']})"
ORACLE["invalid_polygons"] = _with(a=dv.LAND) + """select id, case id%5 when 1 then 'hole outside its shell' when 2 then 'shell inside a shell'
  else 'edges cross' end reason from a where id%5 <> 4"""
ORACLE["points_within"] = _with(b=dv.ZONE, p=dv.SPOT) + _Z + f""", q as (select id, unnest([x0//100, x0//100, (x0+99)//100-1, (x0+99)//100-1]) cx,
  unnest([y0//100, (y0+99)//100-1, y0//100, (y0+99)//100-1]) cy from p)
select id from q join z using (cx, cy) group by id having count(*) = 4"""
_STRIP = lambda up, lo, hi: f"coalesce((select sum(greatest(0, least({hi}, place + 200) - greatest({lo}, place - 200))) from r where upright = {up}), 0)"
_ROADS = _with(a=dv.LAND, r=dv.ROAD) + f""", k as (select id, (x1-x0)*(y1-y0) whole, (x1-x0-{_STRIP(1, 'x0', 'x1')})*(y1-y0-{_STRIP(0, 'y0', 'y1')}) rest from a)"""
ORACLE["zone_clip"] = _ROADS + " select id, (whole-rest)::double clip_area from k where whole > rest"
ORACLE["zone_erase"] = _ROADS + " select id, rest::double erase_area from k where rest > 0"
ORACLE["zone_intersection"] = _with(a=dv.LAND, r=dv.ROAD) + """, k as (select a.id left_id, r.id right_id, case when upright = 1
  then greatest(0, least(x1, place + 200) - greatest(x0, place - 200))*(y1-y0) else greatest(0, least(y1, place + 200) - greatest(y0, place - 200))*(x1-x0) end::double area from a, r)
select * from k where area > 0"""
_LONG = 42000 * 400 + 0.5 * 64 * 200**2 * sin(2 * pi / 64)
ORACLE["zone_polygons"] = _with(r=dv.ROAD) + f"select id, {round(_LONG, 2)}::double zone_area, 1 rings, 66 corners from r"

_E = g._E
_XI = " + ".join(f"{a!r}*sin({2*j}*xi)*cosh({2*j}*eta)" for j, a in enumerate(g._ALPHA, 1))
_ETA = " + ".join(f"{a!r}*cos({2*j}*xi)*sinh({2*j}*eta)" for j, a in enumerate(g._ALPHA, 1))
ORACLE["utm_points"] = _with(p=c.PLACES) + f""", t as (select id, radians(lon - 21) lam,
sinh(atanh(sin(radians(lat))) - {_E!r}*atanh({_E!r}*sin(radians(lat)))) t from p),
u as (select id, atan2(t, cos(lam)) xi, atanh(sin(lam)/sqrt(1 + t*t)) eta from t)
select id, round(500000 + {g.SCALE * g._RECT!r}*(eta + {_ETA}), 2) easting,
round({g.SCALE * g._RECT!r}*(xi + {_XI}), 2) northing, true round_trip from u"""
_P = lambda x, y: f"'[' || {x}::double || ',' || {y}::double || ']'"
ORACLE["geojson_lines"] = _with(a=dv.LAND) + f"""select '{{"type":"Feature","properties":{{"id":' || id ||
'}},"geometry":{{"type":"MultiPolygon","coordinates":[[[' || {_P('x0','y0')} || ',' || {_P('x1','y0')} || ',' || {_P('x1','y1')}
|| ',' || {_P('x0','y1')} || ',' || {_P('x0','y0')} || ']]]}}}}' as value from a"""
ORACLE["thin_layer"] = _with(a=dv.LAND) + """select id, x0::double x0, y0::double y0, x1::double x1, y1::double y1,
((x1-x0)*(y1-y0))::double area from a"""

_CLEAR = "o as (" + _sql(dv.OBS) + "), f as (select * from o where cloud < 20)"
ORACLE["scene_filter"] = "with " + _CLEAR + """ select scene_id, cloud, strftime(min(ts), '%Y-%m-%d %H:%M:%S') ts from o
group by scene_id, cloud having cloud < 50 and min(ts) >= timestamp '1996-04-01' and min(ts) < timestamp '1999-09-30'"""
_NDVI = "case when nir+red = 0 then null else (nir-red)/(nir+red) end"
_NDWI = "case when green+nir = 0 then null else (green-nir)/(green+nir) end"
_SAVI = "(nir-red)*1.5e0/(nir+red+0.5e0)"
ORACLE["ndvi_rows"] = "with " + _CLEAR + f" select pixel_id, scene_id, red, nir, {_NDVI} ndvi from f"
_MED = "m as (select pixel_id, " + ", ".join(f"median({b}) {b}" for b in ("blue", "green", "red", "nir", "swir")) + " from f group by pixel_id)"
ORACLE["median_composite"] = "with " + _CLEAR + ", " + _MED + f" select *, {_NDVI} ndvi, {_NDWI} ndwi, {_SAVI} savi from m"
ORACLE["median_ndvi"] = "with " + _CLEAR + f" select pixel_id, greatest(-1, least(1, median({_NDVI}))) ndvi from f group by pixel_id"
ORACLE["best_scene"] = "with " + _CLEAR + f""" select pixel_id, scene_id, greatest(-1, least(1, {_NDVI})) ndvi from o
where scene_id = (select scene_id from o order by cloud, scene_id limit 1)"""
ORACLE["clearest_pixels"] = "with " + _CLEAR + """, r as (select *, row_number() over
(partition by pixel_id order by cloud, scene_id, blue, green, red, nir, swir) k from o)
select pixel_id, cloud, scene_id, blue, green, red, nir, swir from r where k = 1"""
ORACLE["point_values"] = "with " + _CLEAR + """, p as (select c_custkey id, (c_custkey*6151)%40000 x, (c_custkey*50021)%31000 y from customer),
k as (select x//1000 cx, y//1000 cy, avg(red) red, avg(nir) nir from o group by all)
select p.id, round(k.red, 9) red, round(k.nir, 9) nir from p left join k on p.x//1000 = cx and p.y//1000 = cy"""
ORACLE["weather_cells"] = _with(w=dv.WEATHER) + """select cx, cy, round(avg(temperature_2m), 6) temperature_2m,
round(avg(total_precipitation), 9) total_precipitation from w group by cx, cy"""
ORACLE["raster_profile"] = "with " + _CLEAR + f""" select min(x) x0, min(y) y0, max(x) x1, max(y) y1, min({_NDVI}) min_value,
max({_NDVI}) max_value, count({_NDVI}) pixels from o"""
_FEAT = _CLEAR + ", " + _MED + f""", w as ({_sql(dv.WEATHER)}),
wm as (select cx, cy, avg(temperature_2m) t, avg(total_precipitation) p from w group by cx, cy),
s as (select p_partkey sample_id, (p_partkey*7919)%40000 x, (p_partkey*104729)%31000 y from part),
i as (select *, {_NDVI} ndvi, {_NDWI} ndwi, {_SAVI} savi from m),
ff as (select s.sample_id, i.*, coalesce(t - 273.15e0, 20) temperature, coalesce(greatest(20, least(95, p*100000e0/7)), 60) humidity
from s join i on sample_id = pixel_id left join wm on floor(x/11132e0) = cx and floor(y/11132e0) = cy)"""
_CLIP = lambda col, lo, hi: f"round(greatest({lo}, least({hi}, {col})), 6)"
ORACLE["feature_frame"] = "with " + _FEAT + f""" select sample_id, {_CLIP('ndvi', 0, 1)} ndvi, {_CLIP('temperature', 5, 35)} temperature,
{_CLIP('humidity', 20, 95)} humidity, {_CLIP('red', 0.01, 0.3)} red_band, {_CLIP('nir', 0.2, 0.7)} nir_band, round(ndwi, 6) ndwi,
{_CLIP('savi', 0, 1)} savi from ff where red is not null and nir is not null and ndvi is not null"""
ORACLE["rule_labels"] = "with " + _FEAT + f""" select sample_id, case when ndvi > 0.78e0 and nir > 0.45e0 then 'Kukuruz'
when ndvi > 0.76e0 and ndwi < 0.1e0 then 'Soja' when ndvi > 0.7e0 and ndwi > 0.1e0 then 'Pšenica'
when swir > 0.25e0 and ndvi < 0.65e0 then 'Suncokret' when ndvi < 0.65e0 and red > 0.08e0 then 'Ječam'
when ndvi > 0.72e0 and ndwi > 0.15e0 then 'Krompir'
else list_extract(['Pšenica', 'Kukuruz', 'Suncokret', 'Soja', 'Ječam', 'Krompir'],
 ({_mix('sample_id')} % 6 + 1)::int) end crop_type from ff where ndvi is not null and savi is not null"""

_SPLIT = f"""row_number() over (partition by label order by {_mix('vec_id')}, vec_id)
<= round(0.2e0 * count(*) over (partition by label))"""
ORACLE["strat_split"] = f"select vec_id, label, {_SPLIT} is_test from (select o_orderkey vec_id, o_orderpriority label from orders)"
ORACLE["strat_split_sizes"] = f"""select label, count(*) filter (t) test, count(*) filter (not t) train
from (select label, {_SPLIT} t from embeddings) group by label"""
ORACLE["class_metrics"] = _with(p=c.PREDICTED) + """, k as (select crop_type as class from p union select predicted from p),
n as (select class, (select count(*) from p where crop_type = class) support,
(select count(*) from p where predicted = class) guessed,
(select count(*) from p where predicted = class and crop_type = class) hits from k),
r as (select class, case when guessed = 0 then 0e0 else hits/guessed end as precision,
case when support = 0 then 0e0 else hits/support end recall, support from n)
select class, precision, recall, case when precision + recall = 0 then 0e0 else 2*precision*recall/(precision+recall) end f1, support from r"""
ORACLE["accuracy"] = _with(p=c.PREDICTED) + "select count(*) filter (crop_type = predicted)/count(*) accuracy from p"
_M = lambda col: f"round(sum({col}::decimal(18,4))::double/count({col}), 2)"
ORACLE["class_stats"] = _with(f=c.FOUND) + f"""select crop_type, count(*) n, {_M('area_ha')} mean_area_ha, {_M('ndvi_mean')} mean_ndvi,
{_M('confidence')} mean_confidence, round(sum(area_ha::decimal(18,4))::double, 2) total_area_ha from f group by crop_type"""
ORACLE["class_counts"] = _with(f=c.FOUND) + "select crop_type, count(*) n from f group by crop_type"
ORACLE["detections"] = """select p_partkey detection_id, case when p_size < 20 then 'Soja' when p_size < 40 then 'Kukuruz' else 'Trava' end crop_type,
round_even(p_size/64e0*100, 1) confidence, round(p_size/50e0, 4) ndvi_mean, null::double lai_estimate,
round(0.005e0*0.005e0*111000e0*111000e0*0.0001e0*cos(radians(44.73e0 + (p_partkey*104729%520)/1000e0)), 2) area_ha,
round(44.73e0 + (p_partkey*104729%520)/1000e0, 6) latitude, round(19.05e0 + (p_partkey*7919%1300)/1000e0, 6) longitude,
20e0 temperature, 60e0 humidity, 'RandomForest + Sentinel-2' detection_method,
case when p_size < 20 then '#32CD32' when p_size < 40 then '#FFD700' else '#999' end color from part"""
_EDITED = _with(e=c.EDITS) + """, k as (select e.*, case when c_custkey is null then 'unknown detection'
when attribute not in ('confidence', 'crop_type') then 'unknown attribute'
when attribute = 'confidence' and try_cast(value as decimal(5,1)) is null then 'not a number' end reason
from e left join customer on detection_id = c_custkey)"""
ORACLE["edit_detections"] = _EDITED + """, r as (select *, row_number() over (partition by detection_id, attribute order by seq desc) n
from k where reason is null)
select c_custkey detection_id, coalesce(t.value, c_mktsegment) crop_type, coalesce(try_cast(f.value as double), 50e0) confidence
from customer left join r t on t.detection_id = c_custkey and t.attribute = 'crop_type' and t.n = 1
left join r f on f.detection_id = c_custkey and f.attribute = 'confidence' and f.n = 1"""
ORACLE["rejected_edits"] = _EDITED + " select reason, count(*) n from k where reason is not null group by reason"

ORACLE["detections_saved"] = f"""select detection_id, crop_type, case when detection_id%3 = 0 then confidence else 1.5e0 end confidence, area_ha, color,
round(longitude - 0.0025e0, 9) x0, round(latitude - 0.0025e0, 9) y0, round(longitude + 0.0025e0, 9) x1, round(latitude + 0.0025e0, 9) y1
from ({ORACLE['detections']})"""
ORACLE["detection_report"] = _with(k=c.SCORED, u=c.DEGREES, p=c.PLACED, b=dv.LINE) + f""", f as ({ORACLE['detections']}),
a as (select sample_id id, predicted, longitude - 0.0025e0 x0, latitude - 0.0025e0 y0, longitude + 0.0025e0 x1, latitude + 0.0025e0 y1 from k),
m as (select a.id, predicted, b.id lu from a left join u b on {_MEET}),
g as (select detection_id, sqrt(min({_GAP2})) gap from (select *, x0 x1, y0 y1 from p) a, b group by detection_id)
select 'class_stats' part, crop_type label, count(*) a, 0 b, round({_M('confidence')}, 4) as value from f group by crop_type
union all select 'landuse_overlap', predicted, id, lu, 0e0 from m
union all select 'landuse_matched', '', count(distinct id) filter (lu is not null), count(distinct id), 0e0 from m
union all select 'road_distance', '', detection_id, 0, round(gap, 4) from g
union all select 'road_distance_stats', '', 0, 0, round(avg(gap), 4) from g"""
ORACLE["feature_gaps"] = "with " + _FEAT.replace("from w group by cx, cy", "from w where cx <> 1 group by cx, cy").replace("coalesce(greatest(20, least(95, p*100000e0/7)), 60)", "case when p is null then 60 else greatest(20, least(95, p*100000e0/7)) end") + f""" select sample_id,
{_CLIP('ndvi', 0, 1)} ndvi, {_CLIP('temperature', 5, 35)} temperature, {_CLIP('humidity', 20, 95)} humidity, {_CLIP('red', 0.01, 0.3)} red_band,
{_CLIP('nir', 0.2, 0.7)} nir_band, round(case when sample_id%5 = 0 then 0.15e0 else coalesce(ndwi, 0.15e0) end, 6) ndwi,
{_CLIP('case when sample_id%3 = 0 then ndvi*0.8e0 + 0.1e0 else savi end', 0, 1)} savi
from ff where sample_id%7 <> 0 and red is not null and nir is not null and ndvi is not null"""
ORACLE["scene_window"] = _with(t=c.TILES) + """select scene_id, tx::bigint tx, ty::bigint ty, x0, y0, x1, y1 from t where cloud < 60
and ts >= timestamp '1994-01-01' and ts < timestamp '1999-09-30' and x0 <= 23456 and x1 >= 12345 and y0 <= 17890 and y1 >= 6789"""
ORACLE["model_checks"] = f"""with l as ({ORACLE['rule_labels']}), n as (select round(0.2e0 * count(*))::bigint t from l group by crop_type)
select sum(t)::bigint test_rows, count(*) classes, sum(t)::bigint same_after_reload, sum(t)::bigint probable, sum(t)::bigint known_class,
true importances_add_up from n"""
# A turned cell of 100 m spans two columns of 100 m: it is half a square in either, cut at x = (cx - cy) * 100.
ORACLE["even_points"] = _with(b=dv.ZONE) + _Z + """, h as (select cx - cy k from z union all select cx - cy - 1 from z)
select floor(k/10)::bigint cx, round(count(*)*10000e0, 2) area, true even, true all_inside, 500 points from h group by floor(k/10)"""
