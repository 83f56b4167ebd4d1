"""Totals of all subtrees of a forest by parallel tree contraction.

A round looks at every node's children once. Leaves are raked: their total is known, and is added to
their parent. Chains are compressed: a node with one child, and with a larger hash than that
child and than its parent, is taken out, and the child is hung up at the parent with what the
node had on its edge. About half of the leaves and a third of every chain go in a round, so that the
rounds grow with the logarithm of the nodes, whatever the depth or the number of children.
Afterwards the rounds are undone from the last to the first: a node that was taken out has its own
sum, the edge to its child at that time, and the child's total.

All joins are on nodes, with one row a node on either side; children are counted by aggregations
that combine early. So neither a node with very many children nor a long chain is a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.tables import made_folder, stored


def _rank(node: Column, round_number: int) -> Column:
    """An order of nodes that is dealt anew in each round; ties of hashes are told apart by the node."""
    return F.struct(F.xxhash64(node, F.lit(round_number)), node)


def subtree_totals(nodes: DataFrame, values: Sequence[str]) -> DataFrame:
    """(id, ``values``) with the sums of the ``values`` over the subtree of each node, itself included.

    ``nodes`` has id (of any type that can be ordered), parent (null for a root) and the long columns
    ``values``, not null. Every id is there once and every parent is an id; there are no cycles. An
    empty table gives no rows. A table of the size of what is left is stored twice a round.
    """
    spark = nodes.sparkSession
    own = [f"own{i}" for i in range(len(values))]
    edge = [f"edge{i}" for i in range(len(values))]
    zero = F.lit(0).cast("long")
    active = stored(
        nodes.select("id", "parent", *[F.col(f"`{v}`").cast("long").alias(o) for v, o in zip(values, own)], *[zero.alias(e) for e in edge]),
        "tree",
    )
    rounds = []
    while not active.where("parent is not null").isEmpty():
        # Of the only child of a node, the smallest is the child and sums are its own.
        below = active.where("parent is not null").groupBy(F.col("parent").alias("above"))
        kids = below.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("kid"), *[F.sum(e).alias(f"kid_{e}") for e in edge])
        seen = active.join(kids, F.col("id") == F.col("above"), "left").drop("above")
        number = len(rounds)
        highest = (_rank(F.col("id"), number) > _rank(F.col("kid"), number)) & (_rank(F.col("id"), number) > _rank(F.col("parent"), number))
        out = F.coalesce((F.col("n") == 1) & F.col("parent").isNotNull() & highest, F.lit(False))
        seen = stored(seen.withColumn("out", out), f"round{number}")
        rounds.append(seen)

        gone = seen.where("out").select(
            F.col("kid").alias("heir"), F.col("parent").alias("new_parent"), *[(F.col(o) + F.col(e)).alias(f"more_{e}") for o, e in zip(own, edge)]
        )
        left = seen.where("not out").join(gone, F.col("id") == F.col("heir"), "left")
        hung = F.when(F.col("heir").isNotNull(), F.col("new_parent")).otherwise(F.col("parent"))
        left = left.select(
            "id", hung.alias("parent"), *own, *[(F.col(e) + F.coalesce(f"more_{e}", zero)).alias(e) for e in edge], F.col("n").isNull().alias("leaf")
        )
        raked = left.where("leaf and parent is not null").groupBy(F.col("parent").alias("above"))
        raked = raked.agg(*[F.sum(F.col(o) + F.col(e)).alias(f"add_{o}") for o, e in zip(own, edge)])
        kept = left.where("not leaf or parent is null").join(raked, F.col("id") == F.col("above"), "left")
        active = stored(kept.select("id", "parent", *[(F.col(o) + F.coalesce(f"add_{o}", zero)).alias(o) for o in own], *edge), "tree")

    # Back from the last round: totals are written once, those of later rounds are read for earlier ones.
    folder = made_folder(spark, "totals")
    rest = active.select("id", *own)
    rest.write.parquet(f"{folder}/rest")
    known = spark.read.option("recursiveFileLookup", True).schema(rest.schema)
    for number, seen in reversed(list(enumerate(rounds))):
        leaves = seen.where("n is null and parent is not null").select("id", *own)
        later = known.parquet(folder).unionByName(leaves).select(F.col("id").alias("kid"), *[F.col(o).alias(f"kid_{o}") for o in own])
        undone = seen.where("out").join(later, "kid")
        undone = undone.select("id", *[(F.col(o) + F.col(f"kid_{e}") + F.col(f"kid_{o}")).alias(o) for o, e in zip(own, edge)])
        leaves.unionByName(undone).write.parquet(f"{folder}/round{number}")
    return known.parquet(folder).select("id", *[F.col(o).alias(v) for o, v in zip(own, values)])
