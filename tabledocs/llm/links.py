"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabledocs.llm.shared import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in `links` (a, b): the smallest node that can be reached.

    In each round a node points at its smallest neighbour and at what that one
    points at; links between the targets go on. Paths shrink by half or more, so
    the number of rounds is logarithmic. A node with very many links costs one
    partial minimum per task; the joins are ordinary ones that Spark may split.
    Repeated links, loops and an empty table are fine; links with a null are dropped.
    """
    links = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("to")))
        jump = nearest.select(F.col("node").alias("to"), F.col("to").alias("last"))
        nearest = cut(nearest.join(jump, "to").select("node", F.col("last").alias("to")))
        here, there = (nearest.select(F.col("node").alias(x), F.col("to").alias(f"{x}_to")) for x in "ab")
        moved = links.join(here, "a").join(there, "b").select("a_to", "b_to").where("a_to <> b_to")
        links = cut(moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct())
        if labels is None:
            labels = nearest
        else:
            step = nearest.select(F.col("node").alias("to"), F.col("to").alias("last"))
            labels = cut(labels.join(step, "to", "left").select("node", F.coalesce("last", "to").alias("to")))
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.select("node", F.col("to").alias("component"))
