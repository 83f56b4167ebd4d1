"""The prefix trie of conversations: what they share, counted once.

A node is a sequence of turns that some conversation begins with. It is known by 128 bits: the sums
of position-wise hashes of its turns. Sums of prefixes need no order of their rows in a task: they are
made in chunks of positions side by side and moved on by the sums of the chunks before, so that a
conversation of any length is spread. Subtree totals come from tree contraction.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.contraction import subtree_totals
from tidings.llm.numbering import numbered
from tidings.llm.tables import stored, stored_alone

#: Turns that one task numbers or sums together.
CHUNK_TURNS = 4096
#: Ids of a node that are joined to one text before they are digested.
RUN_IDS = 256
_PIECES = [f"p{i}" for i in range(4)]


def rebuilt_turns(conversations: DataFrame, borrowed: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another, and their turns.

    The first ``borrowed`` turns (at most ``most``) of conversation ``base`` come first, all if it has
    fewer and none if there is none, then a conversation's own turns without its first ``borrowed``.
    Both are columns of conv_id. Turns are in the order of turn (null first), then role and text.

    Returns (conv_id, turns) of every conversation, and (conv_id, place from 1, role, text).
    """
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    # A digest of the text puts turns with one number in a fixed order, without texts as range bounds.
    rows = rows.withColumn("order", F.concat_ws(":", F.sha2("role", 256), F.sha2("text", 256)))
    turns = stored(numbered(rows, ["conv_id"], ["turn", "order"], "place").select("conv_id", "place", "role", "text"), "turns")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", borrowed.cast("long")).withColumn("base", base.cast("long"))
    sizes = stored(sizes, "sizes")
    lenders = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    sized = sizes.join(lenders, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0))))
    sized = sized.withColumn("turns", F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    sized = stored(sized.select("conv_id", "base", "h", "lent", "turns"), "rebuilt")
    first = turns.where(F.col("place") <= most).select(F.col("conv_id").alias("base"), "place", "role", "text")
    lent = sized.select("conv_id", "base", "lent").join(first, "base").where("place <= lent").select("conv_id", "place", "role", "text")
    own = turns.join(sized.select("conv_id", "h", "lent"), "conv_id").where("place > h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("lent")).alias("place"), "role", "text")
    return sized.select("conv_id", "turns"), lent.unionByName(own)


def _halves(number: Column) -> list[Column]:
    """The upper and the lower 32 bits, as numbers whose sums over any conversation fit a long."""
    return [F.shiftrightunsigned(number, 32), number.bitwiseAND(F.lit((1 << 32) - 1))]


def _node(depth: Column, sums: list[Column]) -> Column:
    return F.struct(F.xxhash64(depth, *sums).alias("a"), F.xxhash64(*sums[::-1], depth).alias("b"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, place, role, text) as (conv_id, depth, node, parent, n_bytes).

    ``node`` stands for the first ``depth`` turns and ``parent`` for those without the last, whose text has
    ``n_bytes`` bytes of UTF-8.
    """
    said = [F.col("place"), F.col("role"), F.col("text")]
    marks = [*_halves(F.xxhash64(F.lit("a"), *said)), *_halves(F.xxhash64(*said[::-1], F.lit("b")))]
    chunk = F.floor((F.col("place") - 1) / CHUNK_TURNS)
    rows = turns.select("conv_id", "place", chunk.alias("chunk"), F.octet_length("text").alias("n_bytes"), *[m.alias(p) for m, p in zip(marks, _PIECES)])
    rows = stored(rows, "marks")
    inside = Window.partitionBy("conv_id", "chunk").orderBy("place")
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "chunk").agg(*[F.sum(p).alias(p) for p in _PIECES])
    before = totals.select("conv_id", "chunk", *[F.sum(p).over(earlier).alias(f"{p}_before") for p in _PIECES]).where("p0_before is not null")
    summed = rows.select("conv_id", "chunk", "place", "n_bytes", *_PIECES, *[F.sum(p).over(inside).alias(f"{p}_sum") for p in _PIECES])
    summed = summed.join(before, ["conv_id", "chunk"], "left")
    sums = [F.col(f"{p}_sum") + F.coalesce(f"{p}_before", F.lit(0)) for p in _PIECES]
    return summed.select(
        "conv_id",
        F.col("place").alias("depth"),
        _node(F.col("place"), sums).alias("node"),
        _node(F.col("place") - 1, [s - F.col(p) for s, p in zip(sums, _PIECES)]).alias("parent"),
        F.col("n_bytes").cast("long").alias("n_bytes"),
    )


def joined_digests(members: DataFrame) -> DataFrame:
    """(node, ends_sha256): the SHA-256 of the conv_ids of each node of ``members``, ascending, joined by commas.

    A digest follows one order, so a node's text goes through one task. What goes there is runs of ids,
    joined side by side in ranges of (node, conv_id); the task reads them one by one and keeps a digest.
    """
    dealt = numbered(members, ["node"], ["conv_id"], "place")
    run = F.floor((F.col("place") - 1) / RUN_IDS)
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    runs = dealt.groupBy("node", run.alias("run")).agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        a = b = state = None
        done: list[tuple[int, int, str]] = []
        for batch in batches:
            for x, y, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if state is not None and (x, y) == (a, b):
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    done.append((a, b, state.hexdigest()))
                a, b, state = x, y, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["a", "b", "ends_sha256"])
                done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([a]), pa.array([b]), pa.array([state.hexdigest()])], ["a", "b", "ends_sha256"])

    flat = runs.select("node.a", "node.b", "ids", "run").repartition("a", "b").sortWithinPartitions("a", "b", "run")
    digests = flat.select("a", "b", "ids").mapInArrow(digest, "a long, b long, ends_sha256 string")
    return digests.select(F.struct("a", "b").alias("node"), "ends_sha256")


def prefix_trie(sizes: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations, from :func:`rebuilt_turns` or alike.

    ``sizes`` has every conv_id once with its number of ``turns``; ``turns`` has conv_id, place (from 1,
    without gaps), role and text. Columns: conv_id (smallest member), depth, parent_conv_id (null for
    the root), n_convs (members: the conversations that begin with the node), n_children, n_leaves (nodes
    without children in the subtree, itself included), saved_tokens (over the subtree, bytes of a node's
    last text times its members but one), ends_sha256 (of the members that end here). No conversations: no nodes.
    """
    begun = stored(prefixes(turns), "prefixes")
    root = _node(F.lit(0).cast("long"), [F.lit(0).cast("long")] * 4)
    nodes = begun.groupBy("node", "depth", "parent").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes")
    )
    top = sizes.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        root.alias("node"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("struct<a: long, b: long>").alias("parent"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("n_bytes"),
    )
    nodes = stored(nodes.unionByName(top), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = stored(nodes.join(above, "parent", "left"), "family")
    tree = nodes.select(
        F.col("node").alias("id"),
        "parent",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    totals = stored_alone(lambda: subtree_totals(tree, ["n_leaves", "saved_tokens"]), "totals").withColumnRenamed("id", "node")
    last = begun.join(sizes, "conv_id").where(F.col("depth") == F.col("turns")).select("node", "conv_id")
    last = last.unionByName(sizes.where("turns = 0").select(root.alias("node"), "conv_id"))
    return (
        nodes.join(totals, "node")
        .join(joined_digests(last), "node", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
