"""Exact duplicates by deterministic block naming.

A text without its blanks is cut into blocks of a fixed number of bytes. Distinct blocks are sorted and get integer
names; neighbouring names are paired and the pairs named in the same way, until every document is one name. Equal
names mean equal bytes: names are given to distinct bytes, never to hashes.

Only the distinct blocks travel as bytes, once, and repeats are folded before the shuffle. A block finds its name by
a 64-bit hash; where two blocks share one, their bytes decide.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import BLANKS, ROW_HASH, keep_rows, materialise, row_hash

BLOCK = 8192


def bare(text: Column) -> Column:
    """The text without blanks, as bytes; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "").cast("binary")


def _blocks(data: Column, size: int, each) -> Column:
    last = lambda b: F.floor(F.greatest(F.octet_length(b) - 1, F.lit(0)) / size).cast("int")
    cut = lambda b: F.transform(F.sequence(F.lit(0), last(b)), lambda i: each(F.substring(b, i * size + 1, F.lit(size))))
    return F.element_at(F.transform(F.array(data), cut), 1)  # the outer array has the bytes made once


def _named(distinct: DataFrame, *by: str) -> DataFrame:
    """Integer names in sorted order."""
    return materialise(distinct.sort(*by).withColumn("name", F.monotonically_increasing_id()))


def _block_names(docs: DataFrame, text: str, rows: DataFrame, size: int, hashed) -> DataFrame:
    """(rid, n, pos, name) for every block of every row; rows: (rid, hashes)."""
    blocks = docs.select(F.explode(_blocks(bare(F.col(text)), size, lambda b: b)).alias("block"))
    distinct = blocks.select(hashed(F.col("block")).alias("h"), "block").groupBy("h", "block").agg(F.count(F.lit(1)).alias("seen"))
    per_hash = materialise(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("blocks")))
    places = rows.select("rid", F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "h"))
    shared = per_hash.where("blocks > 1").select("h")
    if shared.isEmpty():
        return places.join(_named(per_hash.select("h"), "h"), "h").select("rid", "n", "pos", "name")
    # some hash stands for several blocks: their order among themselves completes the name
    order = Window.partitionBy("h").orderBy("block")
    tied = materialise(distinct.join(shared, "h", "left_semi").withColumn("nth", F.row_number().over(order)).select("h", "block", "nth"))
    names = _named(per_hash.select("h", F.explode(F.sequence(F.lit(1), F.col("blocks").cast("int"))).alias("nth")), "h", "nth")
    own = places.join(shared, "h", "left_anti").withColumn("nth", F.lit(1))
    texts = docs.select(row_hash(docs).alias("rh"), _blocks(bare(F.col(text)), size, lambda b: b).alias("blocks")).dropDuplicates(["rh"])
    far = places.join(shared, "h", "left_semi").join(rows.select("rid", ROW_HASH), "rid").join(texts, F.col(ROW_HASH) == F.col("rh"))
    far = far.withColumn("block", F.element_at("blocks", F.col("pos") + 1)).join(tied, ["h", "block"])
    cols = ["rid", "n", "pos", "h", "nth"]
    return own.select(*cols).unionByName(far.select(*cols)).join(names, ["h", "nth"]).select("rid", "n", "pos", "name")


def identities(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK, hashed=F.xxhash64) -> DataFrame:
    """One row per document row: key, row_hash, rid, n_chars, text_sha256, and its identity (level, name)."""
    data = bare(F.col(text))
    rows = docs.select(
        F.col(key), row_hash(docs).alias(ROW_HASH), F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("n_chars"),
        F.sha2(data, 256).alias("text_sha256"), _blocks(data, block, hashed).alias("hashes"),
    )
    rows = materialise(rows.withColumn("rid", F.monotonically_increasing_id()))
    now = materialise(_block_names(docs, text, rows, block, hashed))
    most = now.agg(F.max("n")).first()[0] or 1
    done = now.where("n = 1").select("rid", F.lit(0).alias("level"), "name")
    for level in range(1, math.ceil(math.log2(most)) + 1):
        half = F.floor(F.col("pos") / 2)
        pairs = now.where("n > 1").groupBy("rid", half.alias("at")).agg(
            F.ceil(F.first("n") / 2).alias("n"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        names = _named(pairs.select("a", "b").distinct(), "a", "b")
        now = materialise(pairs.join(names, ["a", "b"]).select("rid", "n", F.col("at").alias("pos"), "name"))
        done = done.unionByName(now.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))
    return materialise(rows.drop("hashes").join(done, "rid"))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK, hashed=F.xxhash64) -> DataFrame:
    """Which row of each group of equal texts stays.

    Texts are equal when they are the same after deleting blanks (space, tab to carriage return); null counts as
    empty. The row with the most code points stays, then the one with the smallest key (null keys last), then any one
    of rows that agree in both. Returns one row per row of ``docs``: key, keep_id, group_size, kept, text_sha256,
    row_hash. Repeated rows count each; other columns do not matter; an empty table gives an empty result.
    """
    ids = identities(docs, key, text, block, hashed)
    best = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col(key).isNull().alias("u"), F.col(key).alias("keep_id"), F.col("rid").alias("keep_rid")))
    groups = materialise(ids.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")))
    groups = groups.select("level", "name", "group_size", "best.keep_id", "best.keep_rid")
    out = ids.join(groups, ["level", "name"])
    return out.select(key, "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256", ROW_HASH)


def drop_exact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    return keep_rows(docs, exact_groups(docs, key, text).where("kept"), key)
