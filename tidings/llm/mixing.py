"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Every source asks for its share of the mix by weight, but gives at most a number of epochs of what
it has. Sources above that are clamped, and what they cannot give is shared among the others by
weight, until none is above. A target is some whole epochs and a part of one: whole epochs repeat
every document, and the part goes to the documents that come first in a seeded order.

The order is never sorted out. A document's place is a hash; the place where a source's part ends
is narrowed down by sums over cells of hash values, thousands at a time, until the cell has one
place. So a source of any size costs partial sums only, and only sizes and hashes are read for it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.kernels import SPACED, spans, text_blocks
from tidings.llm.tables import stored

#: Places are numbers of so many bits; a round of narrowing looks at 2**CELL_BITS cells of a source.
PLACE_BITS, CELL_BITS = 60, 12


def _place(doc_id: Column, text: Column, seed: int) -> Column:
    """A place below 2**60 that follows from the seed, the id and the text."""
    told = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(told), 1, PLACE_BITS // 4), 16, 10).cast("long")


def sized_documents(docs: DataFrame, source: str = "source", seed: int = 0) -> DataFrame:
    """doc_id, source, place in the seeded order, and size (words between white space) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(3)):
                _, _, counts = spans(SPACED[data], bounds)
                kept = [batch.column(i).slice(first, last - first) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64())], ["doc_id", "source", "place", "size"])

    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        _place(F.col("doc_id").cast("long"), text, seed).alias("place"),
        text.alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, source string, place long, size long")


def numbered_sources(sources: DataFrame) -> DataFrame:
    """``sources`` with ``number``, from 0, in the order of the names' code points, null last.

    Names are dealt out in ranges, numbered inside their range, and moved on by the sizes of the
    ranges before, so that also many sources (such as hosts) are not sorted in one task.
    """
    ranged = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    inside = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last()))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = ranged.withColumn("inside", inside).join(F.broadcast(before), "range")  # as many rows as there are ranges
    return numbered.withColumn("number", F.col("before") + F.col("inside") - 1).drop("range", "before", "inside")


def water_filling(sources: DataFrame, total: float, max_epochs: int = 3) -> DataFrame:
    """``sources`` (source_size, weight) with the ``target`` of each: ``total`` shared by weight, none above
    ``max_epochs`` times its size.

    Each round gives the sources that are not clamped their share of what the clamped leave, and
    clamps those that it puts above their bound. A round is one sum over the sources; the level only
    rises, so that a clamped source stays clamped, and at most as many rounds follow as there are
    sources. Where all are clamped the mix is smaller than ``total``.
    """
    bound = F.col("source_size") * max_epochs
    sources = sources.withColumn("clamped", F.col("source_size") == 0)
    while True:
        free = ~F.col("clamped")
        level = sources.agg(
            F.coalesce(F.sum(F.when(F.col("clamped"), bound)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        share = (total - level["given"]) / level["weight"] if level["weight"] else 0.0
        above = free & (F.lit(share) * F.col("weight") > bound)
        if not sources.where(above).count():
            target = F.when(F.col("clamped"), bound.cast("double")).otherwise(F.lit(share) * F.col("weight"))
            return sources.withColumn("target", target.cast("double")).drop("clamped")
        sources = stored(sources.withColumn("clamped", F.col("clamped") | above), "clamped")


def part_ends(sized: DataFrame, parts: DataFrame) -> DataFrame:
    """Where the part of each source ends: source, ``end`` (a place), and how many words the documents at
    that place give together (``left``) and have (``there``).

    ``parts`` has source and part, less than the source's size. Documents before the end are in the
    part, and together with ``left`` words at the end they have as many words as the part.
    """
    ends = parts.select("source", F.lit(0).cast("long").alias("low"), F.col("part").alias("left"), F.lit(0).cast("long").alias("there"))
    shift = PLACE_BITS
    while shift > 0:
        width, shift = shift, max(0, shift - CELL_BITS)
        inside = sized.where("size > 0").join(ends.select(F.col("source").alias("own"), "low", "left"), F.col("source").eqNullSafe(F.col("own")))
        cell = F.shiftright(F.col("place") - F.col("low"), shift)
        inside = inside.where((F.col("place") >= F.col("low")) & (F.col("place") - F.col("low") < (1 << width)))
        cells = inside.groupBy("source", "low", "left", cell.alias("cell")).agg(
            F.sum("size").alias("words"), F.min("place").alias("first"), F.max("place").alias("last")
        )
        until = F.sum("words").over(Window.partitionBy("source").orderBy("cell"))
        first = cells.withColumn("until", until).where("until > left").groupBy("source", "low", "left")
        found = first.agg(F.min(F.struct("cell", "until", "words", "first", "last")).alias("c"))
        same = F.col("c.first") == F.col("c.last")
        ends = stored(
            found.select(
                "source",
                # A cell of one place is the end; no later round moves it.
                F.when(same, F.col("c.first")).otherwise(F.col("low") + F.shiftleft(F.col("c.cell"), shift)).alias("low"),
                (F.col("left") - F.col("c.until") + F.col("c.words")).alias("left"),
                F.col("c.words").alias("there"),
                (~same).alias("open"),
            ),
            "ends",
        )
        if not ends.where("open").count():
            break
    return ends.select("source", F.col("low").alias("end"), "left", "there")


def mix_sources(
    docs: DataFrame,
    source: str = "source",
    weights: Column | None = None,
    max_epochs: int = 3,
    total: float | None = None,
    seed: int = 0,
) -> DataFrame:
    """Every row's doc_id, source, size, source_size, target of its source, ``repeats`` and ``taken``.

    ``weights`` is the weight of a source by its ``number`` in code point order (null last); without
    one they are 1, 2, 3 in turn. The mix has ``total`` words (as many as all documents have, if
    None). A document is taken ``repeats`` times in full, and from the document where its
    source's part ends come the first words that are missing: ``taken`` words in all, at most
    ``max_epochs`` times its size. What a source gives differs from its target by rounding only.

    Rows that agree in doc_id, source and text share a place in the order; at the end they
    give equal parts, rounded down. A null text has no words; a null source is one source; a null
    id is a document of its own text. An empty table gives no rows. Columns beside doc_id, text
    and ``source`` are not read.
    """
    sized = stored(sized_documents(docs, source, seed), "sized")
    sources = stored(numbered_sources(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "sources")
    weights = F.col("number") % 3 + 1 if weights is None else weights
    weighed = stored(sources.withColumn("weight", weights), "weighed")
    words = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] if total is None else total
    targets = water_filling(weighed, words, max_epochs)
    wanted = F.least(F.round("target").cast("long"), F.col("source_size") * max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(wanted / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long")
    targets = targets.withColumn("wanted", wanted).withColumn("whole", whole)
    targets = stored(targets.withColumn("part", F.col("wanted") - F.col("whole") * F.col("source_size")), "targets")
    ends = part_ends(sized, targets.where("part > 0").select("source", "part"))
    about = targets.select("source", "source_size", "target", "whole").join(
        ends.select(F.col("source").alias("own"), "end", "left", "there"), F.col("source").eqNullSafe(F.col("own")), "left"
    )
    about = about.select(F.col("source").alias("own"), "source_size", "target", "whole", "end", "left", "there")
    joined = sized.join(about, F.col("source").eqNullSafe(F.col("own")))
    before = F.coalesce(F.col("place") < F.col("end"), F.lit(False))
    repeats = F.col("whole") + F.when(before, 1).otherwise(0)
    # The share of a document at the end; by decimals, since words times words may exceed a long.
    share = F.floor(F.col("left").cast("decimal(19,0)") * F.col("size") / F.greatest("there", F.lit(1))).cast("long")
    part = F.when(F.col("place") == F.col("end"), share).otherwise(0)
    taken = repeats * F.col("size") + F.coalesce(part, F.lit(0))
    return joined.select("doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"), taken.cast("long").alias("taken"))
