"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of ``edges`` (a, b): the smallest id that it reaches.

    Every node hooks on to its smallest neighbour if that is smaller, pointers are doubled until
    they end at roots, and edges between roots go on to the next round. At most every second node
    of a component with edges stays a root, so the rounds grow with the logarithm of its size, not with its
    diameter. A node with a third of all edges is one row of an aggregation that combines early.
    """
    left = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    labels = None
    while left.count():
        both = left.select(F.col("a").alias("id"), F.col("b").alias("up")).unionByName(
            left.select(F.col("b").alias("id"), F.col("b").alias("up"))
        )
        roots = stored(both.groupBy("id").agg(F.min("up").alias("up")), "parents")
        while True:
            above = roots.select(F.col("id").alias("up"), F.col("up").alias("top"))
            jumped = stored(roots.join(above, "up").select("id", "top", (F.col("top") != F.col("up")).alias("moved")), "jumped")
            roots = jumped.select("id", F.col("top").alias("up"))
            if not jumped.where("moved").count():
                break
        if labels is None:
            labels = roots.select("id", F.col("up").alias("component"))
        else:
            later = roots.select(F.col("id").alias("component"), "up")
            labels = labels.join(later, "component", "left").select("id", F.coalesce("up", "component").alias("component"))
        one, two = (roots.select(F.col("id").alias(c), F.col("up").alias(f"{c}_up")) for c in "ab")
        merged = left.join(one, "a").join(two, "b").where("a_up <> b_up")
        left = stored(
            merged.select(F.greatest("a_up", "b_up").alias("a"), F.least("a_up", "b_up").alias("b")).distinct(), "edges"
        )
        labels = stored(labels, "labels")
    return labels if labels is not None else left.select(F.col("a").alias("id"), F.col("b").alias("component"))
