import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidings.operators import (
    article_lists,
    article_parts,
    article_states,
    articles_in_one_row,
    merge_articles,
    summarize_articles,
)
from tidings.operators.articles import DEFAULT_MAX_ITEMS, LIST_COLUMNS, SCALAR_COLUMNS

SCHEMA = (
    "GLOBALEVENTID string, SQLDATE string, SOURCEURL string, GoldsteinScale string, AvgTone string, "
    "Cameo_full string, Actor1Name string, Actor2Name string, Actor1Geo_FullName string, Actor2Geo_FullName string"
)
COLUMNS = [
    "SOURCEURL", "FirstEventDate", "EventCount", "EventIDs", "GoldsteinMean", "AvgToneMean", "EventDescriptions",
    "ActorPairs", "GeoPairs",
]


def _random_events(seed, urls, n):
    rng = random.Random(seed)

    def text(*values):
        return rng.choice([*values, None])

    return [
        (
            text(*map(str, range(40))),
            text("20240101", "20240102", "20231231"),
            rng.choice(urls),
            text("1.5", "-2", "bad"),
            text("0.25", "3"),
            text("d1", "d2"),
            text("a", "b"),
            text("c"),
            text("p"),
            text("q", "r"),
        )
        for _ in range(n)
    ]


def _expected(events):
    groups = defaultdict(list)
    for event in events:
        groups[event[2]].append(event)

    def mean(values):
        numbers = [float(v) for v in values if v not in (None, "bad")]
        return round(sum(numbers) / len(numbers), 9) if numbers else None

    return {
        url: (
            min((e[1] for e in rows if e[1]), default=None),
            sum(e[0] is not None for e in rows),
            mean(e[3] for e in rows),
            mean(e[4] for e in rows),
            Counter(e[0] for e in rows if e[0] is not None),
            Counter(e[5] for e in rows if e[5] is not None),
            Counter((e[6], e[7]) for e in rows),
            Counter((e[8], e[9]) for e in rows),
        )
        for url, rows in groups.items()
    }


def _scalars(summary):
    rows = {}
    for row in summary.collect():
        means = [None if row[m] is None else round(row[m], 9) for m in ("GoldsteinMean", "AvgToneMean")]
        assert row.SOURCEURL not in rows
        rows[row.SOURCEURL] = (row.FirstEventDate, row.EventCount, *means)
    return rows


def _lists(summary):
    """Rows of one article put together."""
    merged = {}
    for row in summary.collect():
        lists = [
            Counter(row.EventIDs),
            Counter(row.EventDescriptions),
            Counter(tuple(p) for p in row.ActorPairs),
            Counter(tuple(p) for p in row.GeoPairs),
        ]
        before = merged.get(row.SOURCEURL, [Counter()] * 4)
        merged[row.SOURCEURL] = [a + b for a, b in zip(before, lists)]
    return {url: tuple(lists) for url, lists in merged.items()}


URLS = ["u1", "u2", "u3", None] + ["hot"] * 12


def _events(spark):
    events = _random_events(7, URLS, 400) + [("copy", "20240105", "hot", "1", "1", "d", "x", "y", "z", "w")] * 150
    return events, spark.createDataFrame(events, SCHEMA).repartition(5)


def test_scalars_equal_brute_force(spark):
    events, df = _events(spark)
    summary = summarize_articles(df)
    assert summary.columns == SCALAR_COLUMNS
    assert _scalars(summary) == {url: row[:4] for url, row in _expected(events).items()}


@pytest.mark.parametrize("max_items", [DEFAULT_MAX_ITEMS, 20, 3, 1])
def test_lists_equal_brute_force(spark, max_items):
    """The same columns and grain at every bound; rows never longer than it, all but the last full."""
    events, df = _events(spark)
    lists = article_lists(df, max_items)
    assert lists.columns == ["SOURCEURL", "part", *LIST_COLUMNS]
    assert _lists(lists) == {url: row[4:] for url, row in _expected(events).items()}
    sizes = defaultdict(dict)
    for r in lists.collect():
        assert r.part not in sizes[r.SOURCEURL]
        sizes[r.SOURCEURL][r.part] = len(r.ActorPairs)
    totals = Counter(e[2] for e in events)
    for url, parts in sizes.items():
        last = max(parts)
        assert sorted(parts) == list(range(last + 1)) and sum(parts.values()) == totals[url]
        assert all(n == max_items for part, n in parts.items() if part < last) and 0 < parts[last] <= max_items


def test_one_row_equals_brute_force(spark):
    events, df = _events(spark)
    summary = articles_in_one_row(df)
    assert summary.columns == COLUMNS
    expected = _expected(events)
    assert _scalars(summary) == {url: row[:4] for url, row in expected.items()}
    assert _lists(summary) == {url: row[4:] for url, row in expected.items()}


@pytest.mark.parametrize("max_items", [DEFAULT_MAX_ITEMS, 20, 1])
def test_parts_have_the_scalars_of_the_whole_article(spark, max_items):
    events, df = _events(spark)
    parts = article_parts(df, max_items)
    assert parts.columns == ["SOURCEURL", "part", *COLUMNS[1:]]
    expected = _expected(events)
    scalars = parts.select(*SCALAR_COLUMNS).withColumns({m: F.round(m, 9) for m in ("GoldsteinMean", "AvgToneMean")})
    assert _scalars(scalars.distinct()) == {url: row[:4] for url, row in expected.items()}
    assert _lists(parts) == {url: row[4:] for url, row in expected.items()}


def test_articles_that_share_the_hash_of_a_large_one(spark, monkeypatch):
    """All addresses in one bucket: small articles go the way of large ones, with the same rows."""
    monkeypatch.setattr("tidings.operators.articles.ADDRESS_BUCKETS", 1)
    events, df = _events(spark)
    lists = article_lists(df, 200)
    assert _lists(lists) == {url: row[4:] for url, row in _expected(events).items()}
    sizes = Counter(e[2] for e in events)
    assert {url: n for url, n in lists.groupBy("SOURCEURL").count().collect()} == {u: -(-n // 200) for u, n in sizes.items()}


def test_lists_need_no_scores_and_keep_off_other_columns(spark):
    _, df = _events(spark)
    lean = df.drop("SQLDATE", "GoldsteinScale", "AvgTone").withColumns({c: F.lit(-1) for c in ("large", "n", "part", "item", "run")})
    assert _lists(article_lists(lean, 20)) == _lists(article_lists(df, 20))


def test_events_of_small_articles_are_shuffled_once(spark, capsys):
    _, df = _events(spark)
    lists = article_lists(df)
    lists.collect()
    lists.explain()
    final = capsys.readouterr().out.split("+- == Initial Plan ==")[0]
    items = [line for line in final.splitlines() if " Exchange hashpartitioning(SOURCEURL" in line]
    assert "left_anti" not in final.lower() and len(items) == 1


def test_states_of_parts_merge_to_the_scalars(spark):
    events, df = _events(spark)
    expected = {url: row[:4] for url, row in _expected(events).items()}
    assert _scalars(merge_articles(article_states(df, "SQLDATE"))) == expected
    pieces = [article_states(df.where(F.pmod(F.hash("GLOBALEVENTID"), F.lit(3)) == i)) for i in range(3)]
    assert _scalars(merge_articles(pieces[0].unionByName(pieces[1]).unionByName(pieces[2]))) == expected
    assert merge_articles(article_states(df.limit(0))).collect() == []


def test_grain_does_not_follow_the_data(spark):
    """An article beyond the default bound keeps one scalar row with its whole count."""
    big = spark.range(DEFAULT_MAX_ITEMS + 1).select(
        F.col("id").cast("string").alias("GLOBALEVENTID"), F.lit("20240101").alias("SQLDATE"), F.lit("u").alias("SOURCEURL"),
        *[F.lit("1").alias(c) for c in ("GoldsteinScale", "AvgTone", "Cameo_full", "Actor1Name", "Actor2Name", "Actor1Geo_FullName", "Actor2Geo_FullName")],
    )
    assert [r.EventCount for r in summarize_articles(big).collect()] == [DEFAULT_MAX_ITEMS + 1]
    assert sorted((r.part, len(r.EventIDs)) for r in article_lists(big).collect()) == [(0, DEFAULT_MAX_ITEMS), (1, 1)]


def test_copies_collapse_before_the_shuffle(spark):
    events = [("copy", "20240105", "hot", "1", "1", "d", "x", "y", "z", "w")] * 2000
    lists = article_lists(spark.createDataFrame(events, SCHEMA), 50)
    assert sorted(r[0] for r in lists.select(F.size("EventIDs")).collect()) == [50] * 40


def test_lists_share_one_order(spark):
    events = [
        (str(i), "20240101", "u", "1", "1", f"d{i}", f"a{i}", f"b{i}", f"p{i}", f"q{i}") for i in (3, 1, 2, 5, 4)
    ]
    df = spark.createDataFrame(events, SCHEMA)
    for row in (articles_in_one_row(df).first(), article_lists(df).first()):
        assert row.EventIDs == ["1", "2", "3", "4", "5"]
        assert row.EventDescriptions == [f"d{i}" for i in range(1, 6)]
        assert [p.Actor1Name for p in row.ActorPairs] == [f"a{i}" for i in range(1, 6)]
        assert [p.Actor2Geo_FullName for p in row.GeoPairs] == [f"q{i}" for i in range(1, 6)]


def test_schema(spark):
    types = dict(articles_in_one_row(spark.createDataFrame([], SCHEMA)).dtypes)
    assert types["EventCount"] == "bigint" and types["GoldsteinMean"] == "double"
    assert types["EventIDs"] == types["EventDescriptions"] == "array<string>"
    assert types["ActorPairs"] == "array<struct<Actor1Name:string,Actor2Name:string>>"
    assert types["GeoPairs"] == "array<struct<Actor1Geo_FullName:string,Actor2Geo_FullName:string>>"
