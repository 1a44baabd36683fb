"""Connected components over an edge table, without bringing a component to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component, for every node of an edge table (a, b).

    Each round hooks the label of either end onto the smaller label across every edge, then replaces each label by its
    own label. Tables are written after each round, so joins stay plain and adaptive execution can split a label that
    many nodes share. Self-loops and repeated edges do no harm.
    """
    both = materialise(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        at_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        at_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        ends = both.join(at_a, "a").join(at_b, "b").where("la > lb").select("a", "la", "lb")
        hooks = ends.select(F.explode(F.array("a", "la")).alias("node"), F.col("lb").alias("new")).groupBy("node").agg(F.min("new").alias("new"))
        hooks = materialise(hooks)
        if hooks.isEmpty():
            return labels
        hooked = materialise(labels.join(hooks, "node", "left").select("node", F.least("label", "new").alias("label")))
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = materialise(hooked.join(jump, "label").select("node", F.least("label", "further").alias("label")))
