"""Per-article summaries of events.

No result changes its grain with the data. ``summarize_articles`` has one row per article with its
scalars: they combine before the shuffle, so an article of any size is one small row.
``article_states`` has the same scalars as sums, counts and minima of parts of the events, which
``merge_articles`` puts together. ``article_lists`` has the events of an article in numbered rows of
a bounded length, ``article_parts`` with the scalars beside them. ``articles_in_one_row`` puts
scalars and whole lists into one row per article, for articles whose lists fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_MAX_ITEMS = 50_000
#: Ranges of hash values in which the events of one article are numbered side by side.
RUNS = 1024
#: Hash values of addresses by which the articles with more events than a row holds are told apart.
ADDRESS_BUCKETS = 65_536

# Names of the summary columns, in output order.
SCALAR_COLUMNS = ["SOURCEURL", "FirstEventDate", "EventCount", "GoldsteinMean", "AvgToneMean"]
STATE_COLUMNS = ["FirstEventDate", "EventCount", "GoldsteinSum", "GoldsteinCount", "ToneSum", "ToneCount"]
LIST_COLUMNS = ["EventIDs", "EventDescriptions", "ActorPairs", "GeoPairs"]
EVENT_COLUMNS = [
    "SOURCEURL", "GLOBALEVENTID", "Cameo_full", "Actor1Name", "Actor2Name", "Actor1Geo_FullName", "Actor2Geo_FullName",
]
SCORE_COLUMNS = ["SQLDATE", "GoldsteinScale", "AvgTone"]
ARTICLE_COLUMNS = [
    "SOURCEURL", "FirstEventDate", "EventCount", "EventIDs", "GoldsteinMean", "AvgToneMean", "EventDescriptions",
    "ActorPairs", "GeoPairs",
]


def _statistics() -> list[Column]:
    return [
        F.min("SQLDATE").alias("FirstEventDate"),
        F.count("GLOBALEVENTID").alias("EventCount"),
        F.avg(F.col("GoldsteinScale").try_cast("double")).alias("GoldsteinMean"),
        F.avg(F.col("AvgTone").try_cast("double")).alias("AvgToneMean"),
    ]


def _states() -> list[Column]:
    goldstein, tone = F.col("GoldsteinScale").try_cast("double"), F.col("AvgTone").try_cast("double")
    return [
        F.min("SQLDATE").alias("FirstEventDate"),
        F.count("GLOBALEVENTID").alias("EventCount"),
        F.sum(goldstein).alias("GoldsteinSum"),
        F.count(goldstein).alias("GoldsteinCount"),
        F.sum(tone).alias("ToneSum"),
        F.count(tone).alias("ToneCount"),
    ]


def _merged() -> list[Column]:
    return [F.min("FirstEventDate").alias("FirstEventDate"), *[F.sum(c).alias(c) for c in STATE_COLUMNS[1:]]]


def _means() -> list[Column]:
    return [
        F.try_divide("GoldsteinSum", "GoldsteinCount").alias("GoldsteinMean"),
        F.try_divide("ToneSum", "ToneCount").alias("AvgToneMean"),
    ]


def _item() -> Column:
    return F.struct(
        F.col("GLOBALEVENTID").alias("id"),
        F.col("Cameo_full").alias("description"),
        F.struct("Actor1Name", "Actor2Name").alias("actors"),
        F.struct("Actor1Geo_FullName", "Actor2Geo_FullName").alias("places"),
    )


def _lists() -> list[Column]:
    """List columns of sorted ``items``; NULL ids and descriptions are left out of theirs."""
    return [
        F.array_compact("items.id").alias("EventIDs"),
        F.array_compact("items.description").alias("EventDescriptions"),
        F.col("items.actors").alias("ActorPairs"),
        F.col("items.places").alias("GeoPairs"),
    ]


def summarize_articles(events: DataFrame) -> DataFrame:
    """One row per ``SOURCEURL``: first date, number of events with an id, and mean scores.

    ``FirstEventDate`` is the smallest ``SQLDATE``. NULL addresses form one group; scores that
    are not numbers do not enter the means.
    """
    return events.groupBy("SOURCEURL").agg(*_statistics())


def article_states(events: DataFrame, *by: str) -> DataFrame:
    """What :func:`merge_articles` needs of a part of the events: one row per ``SOURCEURL`` and values of ``by``.

    Kept by date (see ``plans.update_article_states``), states of the days that are there serve again
    when further days come.
    """
    return events.groupBy("SOURCEURL", *by).agg(*_states())


def merge_articles(states: DataFrame) -> DataFrame:
    """The rows of :func:`summarize_articles` from states of all parts of the events.

    Every event must be in the states of one part. Means may differ in their last digits, as sums
    are added up in another order.
    """
    return states.groupBy("SOURCEURL").agg(*_merged()).select("SOURCEURL", "FirstEventDate", "EventCount", *_means())


def _numbered_parts(events: DataFrame, max_items: int, scalars: bool) -> DataFrame:
    """The items of each article in parts, for articles of any size, with its states if ``scalars``.

    Copies are counted before the shuffle. Distinct events are numbered in ranges of hash values,
    many for a large article, each range continuing where those before it end.
    """
    states, merged = (STATE_COLUMNS, _merged()) if scalars else ([], [])
    counts = [F.count("*").alias("copies"), *(_states() if scalars else [])]
    copies = events.groupBy("SOURCEURL", _item().alias("item")).agg(*counts)
    runs = copies.withColumn("run", F.pmod(F.xxhash64("item"), F.lit(RUNS)).cast("int"))
    article = Window.partitionBy("SOURCEURL")
    earlier_runs = article.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = runs.groupBy("SOURCEURL", "run").agg(F.sum("copies").alias("n"), *merged)
    before = totals.select(
        F.col("SOURCEURL").alias("url"),
        F.col("run").alias("own_run"),
        F.coalesce(F.sum("n").over(earlier_runs), F.lit(0)).alias("before"),
        *[(F.min(c) if c == "FirstEventDate" else F.sum(c)).over(article).alias(c) for c in states],
    )
    earlier = Window.partitionBy("SOURCEURL", "run").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("copies").over(earlier), F.lit(0)).alias("ahead")
    numbered = runs.select("SOURCEURL", "run", "item", "copies", ahead)
    same = F.col("SOURCEURL").eqNullSafe(F.col("url")) & (F.col("run") == F.col("own_run"))
    first = F.col("before") + F.col("ahead")
    placed = numbered.join(before, same).select(
        "SOURCEURL", "item", first.alias("first"), (first + F.col("copies")).alias("end"), *states
    )
    parts = placed.select(
        "*", F.explode(F.sequence(F.floor(F.col("first") / max_items), F.floor((F.col("end") - 1) / max_items))).alias("part")
    )
    low, high = F.greatest("first", F.col("part") * max_items), F.least("end", (F.col("part") + 1) * max_items)
    repeated = F.array_repeat("item", (high - low).cast("int"))
    items = F.sort_array(F.flatten(F.collect_list(repeated))).alias("items")
    return parts.groupBy("SOURCEURL", "part").agg(items, *[F.first(c).alias(c) for c in states])


def _parts(events: DataFrame, max_items: int, scalars: bool) -> DataFrame:
    """Sorted items by (``SOURCEURL``, ``part``), with states of the whole article if ``scalars``.

    Events of articles that fit one row are shuffled once, by address. Those of larger ones, and of
    the few whose address has the hash value of a larger one, are numbered first. The hash
    values are at most ``ADDRESS_BUCKETS`` rows, which are broadcast whatever the number of articles.
    """
    events = events.select(*EVENT_COLUMNS, *(SCORE_COLUMNS if scalars else []))
    bucket = F.pmod(F.xxhash64("SOURCEURL"), F.lit(ADDRESS_BUCKETS)).cast("int")
    sizes = events.groupBy("SOURCEURL").agg(F.count("*").alias("n"))
    large = F.broadcast(sizes.where(F.col("n") > max_items).select(bucket.alias("large")).distinct())
    among = bucket == F.col("large")
    items = F.sort_array(F.collect_list(_item())).alias("items")
    small = events.join(large, among, "left_anti").groupBy("SOURCEURL")
    whole = small.agg(items, *(_states() if scalars else [])).withColumn("part", F.lit(0).cast("long"))
    return whole.unionByName(_numbered_parts(events.join(large, among, "left_semi"), max_items, scalars))


def article_parts(events: DataFrame, max_items: int = DEFAULT_MAX_ITEMS) -> DataFrame:
    """Scalars and lists of every article, in rows (``SOURCEURL``, ``part``) of at most ``max_items`` events.

    ``part`` and the lists are those of :func:`article_lists`; each row has the scalars of its whole article.
    """
    rows = _parts(events, max_items, True).select("*", *_means(), *_lists())
    return rows.select("SOURCEURL", "part", *ARTICLE_COLUMNS[1:])


def article_lists(events: DataFrame, max_items: int = DEFAULT_MAX_ITEMS) -> DataFrame:
    """The lists of every article, in rows (``SOURCEURL``, ``part``) of at most ``max_items`` events.

    ``part`` counts from 0, and every part but an article's last is full. The lists of a row share
    one order, ascending by event id; parts are not ordered among each other. No event is
    dropped, copies included.
    """
    return _parts(events, max_items, False).select("SOURCEURL", "part", *_lists())


def articles_in_one_row(events: DataFrame) -> DataFrame:
    """One row per ``SOURCEURL`` with scalars and whole lists, however long they are.

    An explicit choice: all events of an article meet in one task and must fit an array. Use
    :func:`article_parts` where articles are not known to be small.
    """
    items = F.sort_array(F.collect_list(_item())).alias("items")
    return events.groupBy("SOURCEURL").agg(*_statistics(), items).select("*", *_lists()).select(*ARTICLE_COLUMNS)
