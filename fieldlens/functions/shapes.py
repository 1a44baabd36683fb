"""Geometry as column expressions over the shape struct.

A shape is ``struct<kind, parts array<array<struct<x,y>>>>``. For polygons every part is a
closed ring; shells run counter-clockwise and holes clockwise, so the summed winding of a
point is its cover count. A multi-polygon is simply several shells. Frames carry the
bounding box as plain columns x0, y0, x1, y1, which Parquet can prune on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.sources.schemas import BOX, SHAPE


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def make_shape(kind: str, parts: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), parts.alias("parts")).cast(SHAPE)


def point_shape(x: Column, y: Column) -> Column:
    return make_shape("point", F.array(F.array(point(x, y))))


def line_shape(points: Column) -> Column:
    return make_shape("line", F.array(points))


def box_shape(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    ring = F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))
    return make_shape("polygon", F.array(ring))


def polygon_shape(rings: Column) -> Column:
    """A polygon from its rings in any direction: the first is the shell, the rest holes."""

    def turn(ring: Column, i: Column) -> Column:
        return F.when((ring_area(ring) < 0) == (i == 0), F.reverse(ring)).otherwise(ring)

    return make_shape("polygon", F.transform(rings, turn))


def with_bounds(frame: DataFrame, shape: str = "shape") -> DataFrame:
    """Add the bounding box columns of a shape."""
    pts = F.flatten(F.col(shape)["parts"])
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return frame.withColumns(
        {"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)}
    )


def with_box_shape(frame: DataFrame) -> DataFrame:
    """Give a frame that has only a box the box as its shape."""
    return frame.withColumn("shape", box_shape(*[F.col(c) for c in BOX]))


def ring_segments(ring: Column) -> Column:
    """Directed segments between neighbours; a lone vertex gives one of length zero."""

    def seg(u: Column, v: Column) -> Column:
        return F.struct(u["x"].alias("ax"), u["y"].alias("ay"), v["x"].alias("bx"), v["y"].alias("by"))

    n = F.size(ring)
    return F.when(n == 1, F.transform(ring, lambda p: seg(p, p))).otherwise(
        F.zip_with(F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(0))), seg)
    )


def segments(shape: Column) -> Column:
    return F.flatten(F.transform(shape["parts"], ring_segments))


def ring_area(ring: Column) -> Column:
    """Signed area, positive for counter-clockwise."""
    return F.aggregate(
        ring_segments(ring), F.lit(0.0), lambda acc, s: acc + (s["ax"] * s["by"] - s["bx"] * s["ay"]), lambda acc: acc / 2
    )


def area(shape: Column) -> Column:
    """Area of a polygon whose rings do not overlap; 0 for points and lines."""
    total = F.aggregate(shape["parts"], F.lit(0.0), lambda acc, r: acc + ring_area(r))
    return F.when(shape["kind"] == "polygon", total).otherwise(F.lit(0.0))


def is_box(shape: Column, box: tuple[Column, ...]) -> Column:
    """The shape is the whole of its box, as one ring from the lower left corner."""
    return F.coalesce(shape == box_shape(*box), F.lit(False))


def is_straight(shape: Column, box: tuple[Column, ...]) -> Column:
    """One level or upright line, or a lone point, that is the whole of its box."""
    once = lambda c: F.array_sort(F.transform(F.get(shape["parts"], F.lit(0)), lambda p: p[c].cast("double")))
    xs, ys = once("x"), once("y")
    fills = lambda v, lo, hi: (F.get(v, F.lit(0)) == lo) & (F.element_at(v, -1) == hi)
    line = (shape["kind"] == "line") | (F.size(F.get(shape["parts"], F.lit(0))) == 1)
    flat = (shape["kind"] != "polygon") & line & (F.size(shape["parts"]) == 1) & (F.size(F.get(shape["parts"], F.lit(0))) > 0)
    spans = ((box[0] == box[2]) | (box[1] == box[3])) & fills(xs, box[0], box[2]) & fills(ys, box[1], box[3])
    return F.coalesce(F.when(flat, spans), F.lit(False))


def is_convex(shape: Column) -> Column:
    """One closed ring that turns left all around, once: the cover count is 1 inside and 0 outside."""

    def angle(s, t) -> Column:
        ux, uy, vx, vy = s["bx"] - s["ax"], s["by"] - s["ay"], t["bx"] - t["ax"], t["by"] - t["ay"]
        across, along = ux * vy - uy * vx, ux * vx + uy * vy
        # no turn to the right, none back, no segment of length zero
        return F.when((across > 0) | ((across == 0) & (along > 0)), F.atan2(across, along)).otherwise(F.lit(float("inf")))

    def turning(segs: Column) -> Column:
        angles = F.transform(segs, lambda s, i: angle(s, F.get(segs, (i + 1) % F.size(segs))))
        return F.aggregate(angles, F.lit(0.0), lambda acc, a: acc + a)

    ring = shape["parts"][0]
    closed = F.element_at(ring, 1) == F.element_at(ring, -1)
    # four corners as plain columns, which run in generated code
    p = [F.get(ring, F.lit(i)) for i in range(5)]
    sides = [{"ax": u["x"], "ay": u["y"], "bx": v["x"], "by": v["y"]} for u, v in zip(p, p[1:])]
    four = F.lit(0.0)
    for i, s in enumerate(sides):
        four = four + angle(s, sides[(i + 1) % 4])
    around = F.when(F.size(ring) == 5, four).otherwise(F.element_at(F.transform(F.array(ring_segments(ring)), turning), 1))
    once = around.between(6.0, 7.0)
    plain = (shape["kind"] == "polygon") & (F.size(shape["parts"]) == 1) & (F.size(F.get(shape["parts"], F.lit(0))) > 3)
    return F.coalesce(F.when(plain, closed & once), F.lit(False))


def upright_edges(shape: Column) -> Column:
    """The segments that are not vertical, left to right; w is +1 with the interior above, -1 below."""

    def edge(s: Column) -> Column:
        ahead = s["ax"] < s["bx"]
        pick = lambda a, b: F.when(ahead, s[a]).otherwise(s[b])
        ends = [pick(a, b).alias(n) for n, a, b in (("ax", "ax", "bx"), ("ay", "ay", "by"), ("bx", "bx", "ax"), ("by", "by", "ay"))]
        return F.struct(*ends, F.when(ahead, 1.0).otherwise(-1.0).alias("w"))

    return F.transform(F.filter(segments(shape), lambda s: s["ax"] != s["bx"]), edge)


def with_area_under_both(rows: DataFrame, name: str = "area") -> DataFrame:
    """Adds the signed area under the lower of two ``upright_edges`` s and t, over ``_base``.

    Summed over all edges of two polygons whose own rings do not overlap, that is their common area. Each step is a column
    of its own: one expression would repeat the heights until its code is too long to be compiled.
    """

    def at(e: str, x: str) -> Column:
        ax, ay, bx, by = (F.col(f"{e}.{c}") for c in ("ax", "ay", "bx", "by"))
        y = F.when((F.col(x) == ax) | (ay == by), ay).when(F.col(x) == bx, by)
        return y.otherwise(ay + (by - ay) * ((F.col(x) - ax) / (bx - ax))) - F.col("_base")

    rows = rows.withColumns({"_lo": F.greatest("s.ax", "t.ax"), "_hi": F.least("s.bx", "t.bx")})
    rows = rows.withColumns({"_p": at("s", "_lo"), "_q": at("t", "_lo"), "_r": at("s", "_hi"), "_v": at("t", "_hi")})
    rows = rows.withColumns({"_d": F.col("_p") - F.col("_q"), "_e": F.col("_r") - F.col("_v"), "_m": F.least("_p", "_q"), "_n": F.least("_r", "_v")})
    rows = rows.withColumn("_t", F.when(F.col("_d") * F.col("_e") < 0, F.col("_d") / (F.col("_d") - F.col("_e"))))
    meet = F.col("_p") + (F.col("_r") - F.col("_p")) * F.col("_t")
    crossed = F.col("_t") * (F.col("_m") + meet) + (1 - F.col("_t")) * (meet + F.col("_n"))
    height = F.coalesce(crossed, F.col("_m") + F.col("_n")) / 2
    return rows.withColumn(name, F.col("s.w") * F.col("t.w") * (F.col("_hi") - F.col("_lo")) * height)


def boxes_meet(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Closed boxes share a point."""
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def _cross(ox: Column, oy: Column, px: Column, py: Column, qx: Column, qy: Column) -> Column:
    return (px - ox) * (qy - oy) - (py - oy) * (qx - ox)


def segments_meet(s: Column, t: Column) -> Column:
    """Closed segments share a point (collinear and zero-length ones included)."""
    boxes = (
        (F.least(s["ax"], s["bx"]) <= F.greatest(t["ax"], t["bx"]))
        & (F.greatest(s["ax"], s["bx"]) >= F.least(t["ax"], t["bx"]))
        & (F.least(s["ay"], s["by"]) <= F.greatest(t["ay"], t["by"]))
        & (F.greatest(s["ay"], s["by"]) >= F.least(t["ay"], t["by"]))
    )

    def sides(u: Column, v: Column) -> Column:
        first = _cross(u["ax"], u["ay"], u["bx"], u["by"], v["ax"], v["ay"])
        second = _cross(u["ax"], u["ay"], u["bx"], u["by"], v["bx"], v["by"])
        return F.signum(first) * F.signum(second) <= 0

    return boxes & sides(s, t) & sides(t, s)


def turn(s: Column, x: Column, y: Column) -> Column:
    """What one directed segment adds to the winding of a point: 1, -1 or 0."""
    side = _cross(s["ax"], s["ay"], s["bx"], s["by"], x, y)
    up = (s["ay"] <= y) & (s["by"] > y) & (side > 0)
    down = (s["ay"] > y) & (s["by"] <= y) & (side < 0)
    return F.when(up, 1).when(down, -1).otherwise(0)


def winding(segs: Column, x: Column, y: Column) -> Column:
    """Cover count of a point by a polygon's segments, boundary points aside."""
    return F.aggregate(segs, F.lit(0), lambda acc, s: acc + turn(s, x, y))


def _starts_inside(outer: Column, outer_segs: Column, inner: Column) -> Column:
    return (outer["kind"] == "polygon") & F.exists(
        inner["parts"], lambda r: winding(outer_segs, r[0]["x"], r[0]["y"]) != 0
    )


def shapes_meet(a: Column, b: Column) -> Column:
    """The shapes share a point: segments meet, or one lies inside the other."""
    sa, sb = segments(a), segments(b)
    touch = F.exists(sa, lambda s: F.exists(sb, lambda t: segments_meet(s, t)))
    return touch | _starts_inside(a, sa, b) | _starts_inside(b, sb, a)


def point_segment_distance(x: Column, y: Column, s: Column) -> Column:
    dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]
    length2 = dx * dx + dy * dy
    along = F.when(length2 > 0, ((x - s["ax"]) * dx + (y - s["ay"]) * dy) / length2).otherwise(F.lit(0.0))
    t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    ex, ey = x - (s["ax"] + t * dx), y - (s["ay"] + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def segment_distance(s: Column, t: Column) -> Column:
    apart = F.least(
        point_segment_distance(s["ax"], s["ay"], t),
        point_segment_distance(s["bx"], s["by"], t),
        point_segment_distance(t["ax"], t["ay"], s),
        point_segment_distance(t["bx"], t["by"], s),
    )
    return F.when(segments_meet(s, t), F.lit(0.0)).otherwise(apart)


def band(part: Column, d: Column, steps: int) -> Column:
    """Rings whose union is all within distance d of a line: one for each segment, arcs of ``steps`` chords a quarter circle.

    A ring is the segment's rectangle, with the wedge that a bend opens on its outer side at the end, and half circles at
    both ends of the line. Where rings meet they share their edges in opposite directions, so under cover counting only the
    outline and the inner sides of bends are left. Repeated vertices count once; a lone point gives its circle.
    """
    quarter = 3.141592653589793 / 2

    def fresh(p: Column, i: Column, all_: Column) -> Column:
        before = F.get(all_, i - 1)
        return (i == 0) | (p["x"] != before["x"]) | (p["y"] != before["y"])

    once = lambda value, fn: F.element_at(F.transform(F.array(value), fn), 1)

    def heading(s: Column) -> Column:
        return s.withField("h", F.atan2(s["by"] - s["ay"], s["bx"] - s["ax"]))

    def bent(s: Column, i: Column, all_: Column) -> Column:
        raw = F.get(all_, i + 1)["h"] - s["h"]
        return s.withField("next", F.get(all_, i + 1)["h"]).withField("raw", raw)

    def wrapped(s: Column) -> Column:
        bend = F.when(s["raw"] > 2 * quarter, s["raw"] - 4 * quarter).when(s["raw"] <= -2 * quarter, s["raw"] + 4 * quarter).otherwise(s["raw"])
        return s.withField("bend", bend).withField("n", F.greatest(F.ceil(F.abs(bend) / (quarter / steps) - 1e-9), F.lit(1)).cast("int"))

    def spot(x: Column, y: Column, angle: Column) -> Column:
        return point(x + d * F.cos(angle), y + d * F.sin(angle))

    def half(x: Column, y: Column, start: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(2 * steps)), lambda k: spot(x, y, start + k * quarter / steps))

    def ring(s: Column, i: Column) -> Column:
        ax, ay, bx, by = s["ax"], s["ay"], s["bx"], s["by"]
        left, right = s["h"] + quarter, s["h"] - quarter
        at = point(bx, by)
        # the last offset is the next segment's first, taken from its heading, so that both rings have the same point
        outward = lambda side, ks: F.transform(ks, lambda k: spot(bx, by, side + s["bend"] * k / s["n"]))
        end = (
            F.when(s["next"].isNull(), half(bx, by, right))
            .when(s["bend"] > 0, F.concat(outward(right, F.sequence(F.lit(0), s["n"] - 1)), F.array(spot(bx, by, s["next"] - quarter), at, spot(bx, by, left))))
            .when(s["bend"] < 0, F.concat(F.array(spot(bx, by, right), at, spot(bx, by, s["next"] + quarter)), outward(left, F.sequence(s["n"] - 1, F.lit(0), F.lit(-1)))))
            .otherwise(F.array(spot(bx, by, right), at, spot(bx, by, left)))
        )
        start = F.when(i == 0, half(ax, ay, left)).otherwise(F.array(spot(ax, ay, left), point(ax, ay), spot(ax, ay, right)))
        return once(F.concat(end, start), lambda r: F.concat(r, F.slice(r, 1, 1)))

    segs = F.transform(ring_segments(once(part, lambda all_: F.filter(all_, lambda p, i: fresh(p, i, all_)))), heading)
    bends = F.transform(once(segs, lambda all_: F.transform(all_, lambda s, i: bent(s, i, all_))), wrapped)
    return F.transform(bends, ring)


def map_points(shape: Column, fn) -> Column:
    """Apply ``fn(point) -> point`` to every vertex."""
    return F.struct(
        shape["kind"].alias("kind"),
        F.transform(shape["parts"], lambda r: F.transform(r, fn)).alias("parts"),
    ).cast(SHAPE)
