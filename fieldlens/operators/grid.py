"""Spatial joins as equi-joins on grid cells.

Every feature has its own cell size, the power of four just above its box, so it covers
at most four cells whatever its extent: a motorway does not explode into thousands of
rows and a dense cluster of small features is spread over small cells. A pair meets at
the coarser of its two sizes. Each match names the side that owns the size, so at most
one side is ever a small feature reported upward, and two small features that merely
share a coarse cell never become candidates. A pair is kept only in the cell that holds
the lower-left corner of its common box, which makes it unique without a distinct.

Joins on cells are merge joins: file sizes say nothing about rows that are exploded into
cells with their shapes, and a broadcast of those would pass through the driver and leave
the other side in the tasks of its few files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import shapes
from fieldlens.operators.spread import spread
from fieldlens.sources.schemas import BOX

UNIT = 1.0
"""Cell edge at level 0, in the units of the coordinates."""
STEP = 4
MIN_LEVEL = -24
"""Cell edge 4**-24: points get this level, or the finest that the other side uses."""
DIRECT = 4096
"""Pairs of at most so many segment pairs are tested inside their row, larger ones by joins of segments."""


def _level() -> Column:
    span = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    exact = F.ceil(F.log(float(STEP), span / UNIT)).cast("int")
    # below about a millionth of the coordinate, cells would outrun double precision
    reach = F.greatest(*[F.abs(F.col(c)) for c in BOX]) * 1e-6
    least = F.when(reach > 0, F.ceil(F.log(float(STEP), reach / UNIT)).cast("int")).otherwise(MIN_LEVEL)
    return F.greatest(F.when(span > 0, exact).otherwise(MIN_LEVEL), least, F.lit(MIN_LEVEL))


def _size(level: Column) -> Column:
    return F.lit(UNIT) * F.pow(F.lit(float(STEP)), level)


def _spread(frame: DataFrame, at: Column) -> DataFrame:
    """One row per (owner, level, cell) that the feature reports to."""
    cells = frame.withColumn("_at", F.explode(at)).withColumn("_size", _size(F.col("_at.level")))

    def span(lo: str, hi: str) -> Column:
        return F.sequence(F.floor(F.col(lo) / F.col("_size")), F.floor(F.col(hi) / F.col("_size")))

    return cells.withColumn("_cx", F.explode(span("x0", "x1"))).withColumn("_cy", F.explode(span("y0", "y1")))


def _located(frame: DataFrame) -> DataFrame:
    """Rows that have a box, with their level. Rows without one meet nothing."""
    ok = F.lit(True)
    for c in BOX:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return frame.where(ok).withColumns({c: F.col(c).cast("double") for c in BOX}).withColumn("_level", _level())


def _levels(frame: DataFrame) -> Column:
    """The sizes in use on the other side: a scalar subquery of a few dozen integers at most."""
    return frame.select(F.collect_set("_level").alias("levels")).scalar()


def _owner(name: str, level: Column) -> Column:
    return F.struct(F.lit(name).alias("owner"), level.alias("level"))


def _keyed(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides at the cells where they meet, as rows ``l`` and ``r``, and the condition that joins them."""
    a, b = _located(left), _located(right)
    a, b = a.withColumn("_other", _levels(b)), b.withColumn("_other", _levels(a))
    own, other = F.col("_level"), F.col("_other")
    a_at = F.concat(
        F.array(_owner("r", own)),
        F.transform(F.filter(other, lambda v: v > own), lambda v: _owner("r", v)),
        F.when(F.exists(other, lambda v: v < own), F.array(_owner("l", own))).otherwise(F.array().cast("array<struct<owner:string,level:int>>")),
    )
    b_at = F.concat(
        F.array(_owner("r", own)),
        F.transform(F.filter(other, lambda v: v > own), lambda v: _owner("l", v)),
    )
    keys = ["_at.owner", "_at.level", "_cx", "_cy"]
    names = ["owner", "level", "cx", "cy"]

    def keyed(spread: DataFrame, row: str, columns: list[str], prefix: str) -> DataFrame:
        return spread.select(
            F.struct(*columns).alias(row),
            *[F.col(k).alias(f"{prefix}_{n}") for k, n in zip(keys, names)],
            F.col("_size").alias(f"{prefix}_size"),
        )

    ka = keyed(_spread(a, a_at), "l", left.columns, "a")
    kb = keyed(_spread(b, b_at), "r", right.columns, "b")
    cond = F.lit(True)
    for n in names:
        cond = cond & (F.col(f"a_{n}") == F.col(f"b_{n}"))
    return ka, kb, cond & shapes.boxes_meet(*_row_boxes())


def _over_all(side: DataFrame, prefix: str) -> DataFrame:
    """A side over all tasks by its cells: few bytes there make many pairs, and adaptive execution would merge them by bytes."""
    return spread(side, *[f"{prefix}_{n}" for n in ("owner", "level", "cx", "cy")])


def _row_boxes() -> tuple[tuple[Column, ...], tuple[Column, ...]]:
    return tuple(tuple(F.col(f"{s}.{c}") for c in BOX) for s in "lr")


def box_pairs(left: DataFrame, right: DataFrame, on: Column | None = None, keyed: bool = False) -> DataFrame:
    """Pairs whose closed boxes meet, as columns ``l`` and ``r`` holding the rows.

    ``on`` is an extra condition over ``l`` and ``r`` tested inside the join; ``keyed`` tells that it has an equality,
    which the join distributes by as well.
    """
    ka, kb, cond = _keyed(left, right)
    if not keyed:
        ka, kb = _over_all(ka, "a"), _over_all(kb, "b")
    box_l, box_r = _row_boxes()
    size = F.col("a_size")
    cond = (
        cond
        & (F.floor(F.greatest(box_l[0], box_r[0]) / size) == F.col("a_cx"))
        & (F.floor(F.greatest(box_l[1], box_r[1]) / size) == F.col("a_cy"))
    )
    if on is not None:
        cond = cond & on
    return ka.join(kb.hint("merge"), cond).select("l", "r")


def _vertices(shape: Column) -> Column:
    return F.size(F.flatten(shape["parts"])).cast("long")


MARKS = ("_whole", "_n")
"""What the exact test asks of a row, worked out once for all its pairs."""


def marked(layer: DataFrame) -> DataFrame:
    shape, box = F.col("shape"), tuple(F.col(c) for c in BOX)
    return layer.withColumns({"_whole": shapes.is_box(shape, box) | shapes.is_straight(shape, box), "_n": _vertices(shape)})


def exact_test(direct: int | None) -> Column:
    """The exact test of ``marked`` pairs that are small enough to be compared segment by segment in their row."""
    # shapes that fill their boxes meet where the boxes do
    meet = F.when(F.col("l._whole") & F.col("r._whole"), F.lit(True)).otherwise(shapes.shapes_meet(F.col("l.shape"), F.col("r.shape")))
    return meet if direct is None else (F.col("l._n") * F.col("r._n") <= direct) & meet


def _unmarked(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    return pairs.select(*[F.struct(*[F.col(f"{s}.{c}") for c in f.columns]).alias(s) for s, f in (("l", left), ("r", right))])


def _small_enough(layer: DataFrame, other: DataFrame, direct: int) -> DataFrame:
    """Rows that are in some pair of at most ``direct`` segment pairs; shapes too large for any are not taken through the cells."""
    least = other.agg(F.min(_vertices(F.col("shape"))).alias("n")).scalar()
    return layer.where(_vertices(F.col("shape")) * least <= direct)


def meet_pairs(left: DataFrame, right: DataFrame, on: Column | None = None, direct: int | None = DIRECT) -> DataFrame:
    """``box_pairs`` with the exact test where both sides carry a shape.

    Pairs of more than ``direct`` segment pairs are tested by joins of their segments (``meeting.large_pairs``); both
    ways give the same pairs. ``None`` tests all in their row, for layers that are costly to derive and read again.
    """
    if "shape" not in left.columns or "shape" not in right.columns:
        return box_pairs(left, right, on)
    if direct is None:
        return _unmarked(box_pairs(marked(left), marked(right), on).where(exact_test(direct)), left, right)
    few = [marked(_small_enough(*sides, direct)) for sides in ((left, right), (right, left))]
    small = _unmarked(box_pairs(*few, on).where(exact_test(direct)), left, right)
    from fieldlens.operators.meeting import large_pairs

    large = large_pairs(left, right, direct)
    return small.unionByName(large if on is None else large.where(on))


def _names(left: list[str], right: list[str], suffixes: tuple[str, str]) -> list[Column]:
    both = set(left) & set(right)
    return [F.col(f"l.{c}").alias(c + suffixes[0] if c in both else c) for c in left] + [
        F.col(f"r.{c}").alias(c + suffixes[1] if c in both else c) for c in right
    ]


def spatial_join(
    left: DataFrame, right: DataFrame, how: str = "inner", suffixes: tuple[str, str] = ("_left", "_right"), key: str = "id",
    matched: DataFrame | None = None,
) -> DataFrame:
    """Rows of both layers that intersect; clashing names get suffixes.

    ``how='left'`` keeps rows of the left layer without a match, with NULLs: pairs come from the cells with their left rows
    and are not shuffled again, and the rows that ``matched_keys`` does not name are added. Rows that share a key share
    their matches. Layers with a shape column are tested exactly, layers with only a box by their box. Who has the
    ``matched_keys`` of both layers already can give them.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if how == "left":
        geometry = ["shape", *BOX] if "shape" in left.columns and "shape" in right.columns else list(BOX)
        row = F.struct(*left.columns)
        known = left.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.collect_list(row).alias("_rows"))
        placed = known.withColumn("_own", F.explode("_rows")).select("_rows", *[F.col(f"_own.{c}").alias(c) for c in geometry])
        met = meet_pairs(placed, right).select(F.explode("l._rows").alias("l"), "r")
        found = matched_keys(left.where(F.col(key).isNotNull()), right, key) if matched is None else matched
        found = found.withColumnRenamed(key, "_key")
        alone = left.join(found.hint("merge"), F.col(key) == F.col("_key"), "left_anti").select(row.alias("l"))
        pairs = met.unionByName(alone.withColumn("r", F.lit(None).cast(met.schema["r"].dataType)))
    else:
        pairs = meet_pairs(left, right)
    return pairs.select(*_names(left.columns, right.columns, suffixes))


def matched_keys(left: DataFrame, right: DataFrame, key: str = "id", direct: int | None = DIRECT) -> DataFrame:
    """Keys of left rows that meet at least one right row.

    Copies of one geometry on the right count once. A left row leaves a cell at its first match there, so pairs are
    neither made nor shuffled: what is left is one row per key and cell.
    """
    exact = "shape" in left.columns and "shape" in right.columns
    geometry = ["shape", *BOX] if exact else list(BOX)
    rows, others = left.select(*dict.fromkeys([key, *geometry])), right.select(*geometry).distinct()
    found = first_matches(marked(rows), marked(others), key, exact_test(direct)) if exact else first_matches(rows, others, key)
    if exact and direct is not None:
        from fieldlens.operators.meeting import large_pairs

        found = found.unionByName(large_pairs(rows, others, direct).select(F.col(f"l.{key}").alias(key)))
    return found.distinct()


def first_matches(left: DataFrame, right: DataFrame, key: str = "id", on: Column | None = None) -> DataFrame:
    """The key of every left row once for each cell with a right row whose box meets its own and that passes ``on``."""
    ka, kb, cond = _keyed(left, right)
    ka, kb = _over_all(ka, "a"), _over_all(kb, "b")
    return ka.join(kb.hint("merge"), cond if on is None else cond & on, "left_semi").select(F.col(f"l.{key}").alias(key))


def count_matched(left: DataFrame, right: DataFrame, key: str = "id", matched: DataFrame | None = None) -> DataFrame:
    """One row: how many distinct left rows meet the right layer, of how many; ``matched`` are their keys, if known already."""
    total = left.agg(F.count(key).alias("n")).scalar()
    found = matched_keys(left, right, key) if matched is None else matched
    return found.agg(F.count(key).alias("matched"), F.max(total).alias("total"))


def distinct_shapes(frame: DataFrame, key: str = "id") -> DataFrame:
    """One row per geometry, keyed by its smallest id."""
    geometry = ["shape", *BOX] if "shape" in frame.columns else list(BOX)
    return frame.groupBy(*geometry).agg(F.min(key).alias(key)).select(key, *geometry)


def box_overlap_area(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))
