"""Mixing sources by temperature, realised as budgeted block permutations.

The token share of each source is raised to an exponent between 0 (all sources alike) and 1 (as they are). The
exponent is the largest whose weights reach a target entropy and whose rarest source is not repeated beyond a limit.
Weights become whole token budgets. Each source is cut into blocks of about one size by a hash of its keys; every pass
over a source takes its blocks in another order, and the last pass stops where the budget is spent.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import materialise, spare

BLOCK_TOKENS, ENTROPY, REPEATS, SEED = 20_000, 0.97, 4.0, "mix"
_SECTIONS, _ROUNDS, _FAN = 16, 6, 256


def words(text: Column) -> Column:
    """How many runs of signs other than blanks the text has; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(*parts: Column) -> Column:
    """A repeatable number below 2^60 from the parts' text."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def exponent(shares: DataFrame, entropy: float, repeats: float) -> float:
    """The exponent, six decimals. shares: (p) per source, all above zero.

    Entropy falls and repetition shrinks as the exponent grows, so the condition on entropy bounds it from above and
    the one on repetition from below; repetition wins where both cannot hold. Every round narrows the interval to one of 16 sections with one aggregate,
    so the sources themselves stay distributed.
    """
    size, least = shares.agg(F.count(F.lit(1)), F.min("p")).first()
    if not size or size == 1:
        return 1.0

    def bound(holds) -> tuple[float, float]:
        """An interval (a, b): holds(a) and not holds(b), for a condition that holds up to some exponent."""
        a, b = 0.0, 1.0
        for _ in range(_ROUNDS):
            points = [a + (b - a) * i / _SECTIONS for i in range(_SECTIONS + 1)]
            tried = shares.select("p", F.posexplode(F.array(*map(F.lit, points))).alias("i", "x")).withColumn("w", F.pow("p", "x"))
            sums = sorted(tried.groupBy("i").agg(F.sum("w"), F.sum(F.col("w") * F.log("p"))).collect())
            ok = [holds(x, z, zl) for x, (_, z, zl) in zip(points, sums)]
            last = max((i for i, good in enumerate(ok) if good), default=-1)
            if last in (-1, _SECTIONS):
                return points[max(last, 0)], points[max(last, 0)]
            a, b = points[last], points[last + 1]
        return a, b

    high = bound(lambda x, z, zl: math.log(z) - x * zl / z >= entropy * math.log(size) - 1e-12)[0]
    low = bound(lambda x, z, _: least ** (x - 1) / z > repeats)[1] if repeats else 0.0
    return math.floor(max(high, low) * 1e6) / 1e6 if high >= low else math.ceil(low * 1e6) / 1e6


def budgets(totals: DataFrame, budget: int | None, entropy: float, repeats: float) -> DataFrame:
    """(source_key, total, budget) for every source with tokens; totals: (source_key, total)."""
    some = totals.where("total > 0")
    whole = some.agg(F.sum("total")).first()[0] or 0
    if not whole:
        return some.withColumn("budget", F.lit(0).cast("long"))
    spend = whole if budget is None else budget
    shares = some.withColumn("p", F.col("total") / F.lit(float(whole)))
    x = exponent(shares.select("p"), entropy, repeats * whole / spend if repeats else 0.0)
    norm = shares.agg(F.sum(F.pow("p", F.lit(x)))).first()[0]
    return shares.select("source_key", "total", F.round(F.pow("p", F.lit(x)) / norm * spend).cast("long").alias("budget"))


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", budget: int | None = None,
            entropy: float = ENTROPY, repeats: float = REPEATS, block: int = BLOCK_TOKENS, carry: tuple[str, ...] = ()) -> DataFrame:
    """The training order: a row for each time that a document is used.

    Columns: key, source, ``carry``, n_tokens, pass (from 0), block, start_tokens (what the source has spent before
    the block), budget (of the source). Ordering by ``start_tokens / budget`` interleaves the sources at their weights.
    ``budget`` is the tokens to spend in all, by default as many as there are. ``entropy`` is a share of that of equal
    weights. A block that straddles the budget gives its documents in the order of a key hash until the budget is
    spent; the document that reaches it is the last, also among rows of one key and length. Documents without tokens are
    not used. A null source is a source of its own. Repeated rows count each; an empty table gives an empty result.
    Where a carried column has the name of an added one, the added one gets an underscore.
    """
    order = F.coalesce(F.col("key_text"), F.lit("-"))
    own = list(dict.fromkeys([key, source, *carry]))
    of = lambda c: F.col(f"`{c}`")
    base = docs.select(
        F.struct(*[of(c) for c in own]).alias("row"), words(of(text)).alias("n_tokens"),
        F.coalesce(F.concat(F.lit("="), of(source).cast("string")), F.lit("")).alias("source_key"), of(key).cast("string").alias("key_text"),
    ).withColumns({"spot": draw(F.lit(SEED), order), "rank": draw(F.lit("within"), order)})
    narrow = materialise(base.select("source_key", "key_text", "n_tokens", "spot", "rank"))
    totals = materialise(narrow.groupBy("source_key").agg(F.sum("n_tokens").alias("total")))
    plan = materialise(budgets(totals, budget, entropy, repeats))
    plan = plan.withColumn("blocks", F.ceil(F.col("total") / block))
    at_block = (F.col("spot") % F.col("blocks")).alias("block")
    # dealt by source and block, so that a large source does not stay in one task
    blocks = narrow.join(plan, "source_key").withColumn("block", at_block).repartition("source_key", "block").groupBy("source_key", "block").agg(F.sum("n_tokens").alias("size"), F.first("total").alias("total"), F.first("budget").alias("budget"))
    passes = blocks.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("budget") / F.col("total")) - 1).cast("int"))))
    passes = materialise(passes.withColumn("turn", draw(F.lit("pass"), "source_key", "pass", "block")))
    # tokens before each block of a pass: sums of hash ranges first, then inside a range
    part = (F.col("turn") / F.lit(2**60 // _FAN)).cast("int")
    passes = passes.withColumn("part", part)
    ahead = passes.groupBy("source_key", "pass", "part").agg(F.sum("size").alias("of_part"))
    before = Window.partitionBy("source_key", "pass").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = materialise(ahead.select("source_key", "pass", "part", F.coalesce(F.sum("of_part").over(before), F.lit(0)).alias("ahead")))
    inside = Window.partitionBy("source_key", "pass", "part").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("pass") * F.col("total") + F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = passes.join(ahead, ["source_key", "pass", "part"]).withColumn("start_tokens", start.cast("long")).where("start_tokens < budget")
    placed = materialise(placed.select("source_key", "pass", "block", "size", "start_tokens", "budget"))
    # the one block of each source that the budget cuts
    cut = placed.where("start_tokens + size > budget")
    narrowed = narrow.join(plan.select("source_key", "blocks"), "source_key").select("source_key", at_block, "key_text", "n_tokens", "rank")
    spent = Window.partitionBy("source_key", "block").orderBy("rank", "key_text", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    cut_docs = narrowed.join(cut, ["source_key", "block"]).withColumn("before", F.coalesce(F.sum("n_tokens").over(spent), F.lit(0)))
    late = cut_docs.groupBy("source_key", "block", "pass", "rank", "key_text", "n_tokens").agg(
        F.count_if(F.col("start_tokens") + F.col("before") < F.col("budget")).alias("allowed"), F.count(F.lit(1)).alias("alike"))
    late = late.where("allowed > 0").groupBy("source_key", "block", "pass").agg(F.max(F.struct("rank", "key_text", "n_tokens", "allowed", "alike")).alias("last"))
    placed = materialise(placed.join(late, ["source_key", "block", "pass"], "left"))
    rows = base.where("n_tokens > 0").join(plan.select("source_key", "blocks"), "source_key").withColumn("block", F.col("spot") % F.col("blocks"))
    out = rows.join(placed, ["source_key", "block"])
    me, last = F.struct("rank", "key_text", "n_tokens"), F.struct("last.rank", "last.key_text", "last.n_tokens")
    whole = F.col("start_tokens") + F.col("size") <= F.col("budget")
    out = out.where(whole | (me <= last))
    if not placed.where("last.alike > last.allowed").isEmpty():
        # rows of one key and length at the cut: as many as the budget takes
        tie = Window.partitionBy("source_key", "block", "pass", F.when(whole | (me < last), F.xxhash64("row")), whole | (me < last)).orderBy(F.xxhash64("row"))
        out = out.withColumn("nth", F.row_number().over(tie)).where(whole | (me < last) | (F.col("nth") <= F.col("last.allowed")))
    added = [F.col(c).alias(spare(docs.select(*[of(o) for o in own]), c)) for c in ("n_tokens", "pass", "block", "start_tokens", "budget")]
    return out.select(*[F.col("row").getField(c).alias(c) for c in own], *added)
