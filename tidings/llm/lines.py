"""Line deduplication by how much of its site a line is on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.tables import stored

#: Boilerplate lines of all hosts that may be broadcast: about 24 MB of hashes.
BROADCAST_LINES = 1_000_000
#: Share of a host's pages. Lines that hosts repeat are on 2 to 13 % of their pages in the test tables,
#: lines that they share by chance on less than 1 %.
RATIO = 0.02
_BLANKS = " \t\r"


def _line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(line, F.lit(_BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(docs: DataFrame, host: Column | str = "source", ratio: float = RATIO, min_pages: int = 5) -> DataFrame:
    """Lines on more than ``ratio`` of a host's pages and on at least ``min_pages`` of them.

    Columns: host, line_key (a 64-bit hash of the line without outer blanks), pages, host_pages.
    Every row of ``docs`` is a page; a line counts once a page; blank lines do not count. A null
    host is the host with an empty name. By counting, a host has fewer such lines than its mean
    number of lines a page divided by ``ratio``.
    """
    name = F.col(host) if isinstance(host, str) else host
    pages = docs.select(F.coalesce(name.cast("string"), F.lit("")).alias("host"), F.col("text").cast("string").alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    written = F.filter(_lines(F.col("text")), lambda line: F.trim(line, F.lit(_BLANKS)) != "")
    counted = (
        pages.select("host", F.explode(F.array_distinct(F.transform(written, _line_key))).alias("line_key"))
        .groupBy("host", "line_key")
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    return counted.join(totals, "host").where(F.col("pages") > ratio * F.col("host_pages"))


def drop_boilerplate(
    docs: DataFrame, host: Column | str = "source", ratio: float = RATIO, min_pages: int = 5, broadcast_lines: int = BROADCAST_LINES
) -> DataFrame:
    """``docs`` without the :func:`boilerplate` lines of each page's host.

    All rows and columns stay; ``text`` loses the lines, the others keep their order and blanks.
    ``n_lines`` and ``n_dropped`` are added, in place of columns of these names. A null text stays
    null, with 0 lines. A text may become empty. An empty table gives no rows.

    The lines are counted as hashes by host; texts are shuffled only if the boilerplate of all
    hosts has more than ``broadcast_lines`` lines.
    """
    found = stored(boilerplate(docs, host, ratio, min_pages).select("host", "line_key"), "boilerplate")
    by_host = found.groupBy("host").agg(F.collect_set("line_key").alias("keys"))
    if found.count() <= broadcast_lines:
        by_host = F.broadcast(by_host)
    name = F.col(host) if isinstance(host, str) else host
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        F.coalesce(name.cast("string"), F.lit("")).alias("host"),
        _lines(F.col("text").cast("string")).alias("lines"),
    )
    cleaned = rows.join(by_host, "host", "left").withColumn(
        "left_over",
        F.when(F.col("keys").isNull(), F.col("lines")).otherwise(
            F.filter("lines", lambda line: ~F.array_contains("keys", _line_key(line)))
        ),
    )
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return cleaned.select(
        *[F.array_join("left_over", "\n").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in kept],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("left_over"), F.lit(0)).cast("long").alias("n_dropped"),
    )
