"""Polygon set operations as a relational plane sweep.

Within a group, the x axis is cut at every vertex and every crossing. Between two
neighbouring cuts no edges cross, so sorting them by height and summing their signed
weights upward gives the cover count of each strip. The edges are shuffled once by group;
cuts, crossings and strips are windows over the same distribution and need no further
exchange. Groups are tiles or pairs of features, which the callers keep small. No
geometry leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators.spread import spread

SIDES = ("c0", "c1", "c2")


def edges_of(
    frame: DataFrame,
    keys: list[str],
    sides: dict[str, int],
    reach: tuple[Column, Column, Column, Column] | None = None,
    framed: bool = False,
) -> DataFrame:
    """Non-vertical edges of the shape columns named in ``sides``, left to right, with weight
    +1 under the interior and -1 above it. Clockwise rings of holes get the opposite weights.

    ``reach`` is a window (x0, y0, x1, y1): edges are cut to its x range, and edges wholly
    above it are dropped because they cannot change a cover count below them. With
    ``framed`` the window itself is added as side 2, so that strips count only where c2 is
    positive.
    """

    def tagged(column: str, side: int) -> Column:
        return F.transform(
            shapes.segments(F.col(column)), lambda s: F.struct(s.alias("s"), F.lit(side).alias("side"))
        )

    segs = F.concat(*[tagged(column, side) for column, side in sides.items()])
    if framed:
        x0, y0, x1, y1 = reach

        def bar(ax: Column, bx: Column, y: Column) -> Column:
            s = F.struct(ax.alias("ax"), y.alias("ay"), bx.alias("bx"), y.alias("by"))
            return F.struct(s.alias("s"), F.lit(2).alias("side"))

        segs = F.concat(segs, F.array(bar(x0, x1, y0), bar(x1, x0, y1)))
    bounds = [c.alias(n) for c, n in zip(reach, ("_lo", "_low", "_hi", "_top"))] if reach else []
    rows = frame.select(*keys, *bounds, F.explode(segs).alias("e"))
    ahead = F.col("e.s.ax") < F.col("e.s.bx")

    def pick(a: str, b: str) -> Column:
        return F.when(ahead, F.col(f"e.s.{a}")).otherwise(F.col(f"e.s.{b}"))

    edges = rows.where(F.col("e.s.ax") != F.col("e.s.bx")).select(
        *keys,
        *(["_lo", "_hi", "_top"] if reach else []),
        pick("ax", "bx").alias("ax"),
        pick("ay", "by").alias("ay"),
        pick("bx", "ax").alias("bx"),
        pick("by", "ay").alias("by"),
        F.when(ahead, 1).otherwise(-1).alias("w"),
        F.col("e.side").alias("side"),
    )
    return cut(edges, keys) if reach else edges


def cut(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Cut edges to [_lo, _hi] in x and drop those wholly above _top."""
    lo, hi = F.greatest("ax", "_lo"), F.least("bx", "_hi")
    below = (F.least("ay", "by") < F.col("_top")) | (F.col("side") == 2)
    return edges.where(below & (lo < hi)).select(
        *keys, lo.alias("ax"), height(lo).alias("ay"), hi.alias("bx"), height(hi).alias("by"), "w", "side"
    )


def height(x: Column) -> Column:
    """y of the edge at x; exact at its ends."""
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    return (
        F.when((x == ax) | (ay == by), ay)
        .when(x == bx, by)
        .otherwise(ay + (by - ay) * ((x - ax) / (bx - ax)))
    )


def _between(spans: DataFrame, keys: list[str], cuts: Column, lo: str, hi: str) -> DataFrame:
    """Every edge once per slab that it crosses, from a sorted array of cuts in [lo, hi]."""
    inner = F.filter(cuts, lambda x: (x > F.col(lo)) & (x < F.col(hi)))
    stops = F.concat(F.array(F.col(lo)), inner, F.array(F.col(hi)))
    n = F.size("_stops") - 1
    slabs = F.zip_with(
        F.slice("_stops", F.lit(1), n), F.slice("_stops", F.lit(2), n), lambda a, b: F.struct(a.alias("xl"), b.alias("xr"))
    )
    rows = spans.select(*keys, "ax", "ay", "bx", "by", "w", "side", stops.alias("_stops"))
    return rows.select(*keys, "ax", "ay", "bx", "by", "w", "side", F.inline(slabs)).select(
        *keys, "ax", "ay", "bx", "by", "w", "side", "xl", "xr",
        height(F.col("xl")).alias("yl"), height(F.col("xr")).alias("yr"),
    )


def _cut_at_crossings(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Cut the slabs in which edges cross.

    Sorted by their left ends, edges of a slab cross exactly if some right end lies under
    an earlier one. Only slabs where that happens gather their edges and compare them.
    """
    slab = Window.partitionBy(*keys, "xl")
    order = slab.orderBy("yl", "yr")
    tol = (F.abs(F.col("yl")) + F.abs(F.col("yr")) + 1e-3) * 1e-12
    seen = spans.withColumn("_above", F.max("yr").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    marked = seen.withColumn("_bad", F.max(F.coalesce(F.col("_above") > F.col("yr") + tol, F.lit(False))).over(slab))
    gathered = marked.withColumn(
        "_others", F.collect_list(F.when(F.col("_bad"), F.struct(F.col("yl").alias("l"), F.col("yr").alias("r")))).over(slab)
    )
    crossing = F.transform(
        F.filter("_others", lambda o: (o["l"] > F.col("yl")) & (o["r"] < F.col("yr"))),
        lambda o: F.col("xl")
        + (F.col("xr") - F.col("xl")) * ((o["l"] - F.col("yl")) / ((o["l"] - F.col("yl")) + (F.col("yr") - o["r"]))),
    )
    cuts = F.sort_array(F.array_distinct(F.flatten(F.collect_list("_mine").over(slab))))
    found = gathered.withColumn("_mine", crossing).withColumn("_cuts", cuts)
    return _between(found, keys, F.col("_cuts"), "xl", "xr")


def strips(edges: DataFrame, keys: list[str], placed: bool = False) -> DataFrame:
    """All strips between neighbouring edges, with the cover count of each side.

    ``placed`` tells that the edges are spread by the keys already. Result: keys, xl,
    xr, the lower edge (yl, yr), the upper edge (ul, ur), the counts c0, c1, c2 above the
    lower edge, and the counts b0, b1, b2 below it.
    """
    group = Window.partitionBy(*keys)
    vertices = F.sort_array(F.array_union(F.collect_set("ax").over(group), F.collect_set("bx").over(group)))
    edges = edges if placed else spread(edges, *keys)
    spans = _cut_at_crossings(_between(edges.withColumn("_xs", vertices), keys, F.col("_xs"), "ax", "bx"), keys)
    upward = Window.partitionBy(*keys, "xl").orderBy(F.col("yl") + F.col("yr"), F.desc("w"), "side")
    so_far = upward.rowsBetween(Window.unboundedPreceding, 0)
    counts = {
        c: F.coalesce(F.sum(F.when(F.col("side") == i, F.col("w"))).over(so_far), F.lit(0)) for i, c in enumerate(SIDES)
    }
    out = spans.withColumns({**counts, "ul": F.lead("yl").over(upward), "ur": F.lead("yr").over(upward)})
    below = {f"b{i}": F.col(f"c{i}") - F.when(F.col("side") == i, F.col("w")).otherwise(0) for i in range(3)}
    return out.withColumns(below).drop("ax", "ay", "bx", "by")


def strip_area() -> Column:
    """Area of a strip; tiny negative heights from rounding count as zero."""
    h = (F.col("ul") - F.col("yl")) + (F.col("ur") - F.col("yr"))
    return F.coalesce(F.greatest(h, F.lit(0.0)) * (F.col("xr") - F.col("xl")) / 2, F.lit(0.0))


def strip_ring() -> Column:
    """A strip as a counter-clockwise ring."""
    p = shapes.point
    c = F.col
    return F.array(
        p(c("xl"), c("yl")), p(c("xr"), c("yr")), p(c("xr"), c("ur")), p(c("xl"), c("ul")), p(c("xl"), c("yl"))
    )
