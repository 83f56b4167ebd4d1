import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidings.operators import (
    add_actions,
    add_publisher,
    download_plan,
    filter_terms,
    left_lookup,
    one_country_per_domain,
    parse_manifest,
    plan_chunks,
    publisher_lookup,
    range_size,
    select_existing,
    size_lookup,
    total_size,
)
from tidings.operators.manifest import manifest_rejects
from tidings.plans import enrich_events
from tidings.schema import ENRICHMENT_COLUMNS, KEEP_LARGE, KEEP_SHORT, RAW_COLUMNS, RAW_SCHEMA


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_lists():
    assert len(RAW_COLUMNS) == len(set(RAW_COLUMNS)) == 58
    assert len(KEEP_SHORT) == 19 and set(KEEP_SHORT) <= set(RAW_COLUMNS)
    assert len(KEEP_LARGE) == 29 and set(KEEP_LARGE) <= set(RAW_COLUMNS)


def test_select_existing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert select_existing(df, ["c", "x", "a"]).collect() == [(3, 1)]
    assert select_existing(df, ["c", "x", "a"]).columns == ["c", "a"]
    none = select_existing(df, ["x"])
    assert none.schema == df.schema and none.count() == 0


def test_filter_terms(spark):
    df = spark.createDataFrame([("Aus", "x"), (None, "y")], "a string, b string")
    assert filter_terms(df, [], ["a"]).count() == 2
    assert filter_terms(df, ["aus"], []).count() == 2
    assert filter_terms(df, ["AUS"], ["a", "absent"]).collect() == [("Aus", "x")]
    unknown = filter_terms(df, ["aus"], ["absent"])
    assert unknown.schema == df.schema and unknown.count() == 0


OFFICIAL = [("a.com", "Chile"), ("b.com", "Peru"), ("b.com", "Peru"), ("c.com", None)]
MANUAL = [("a.com", "Chile"), ("b.com", "Cuba"), ("b.com", "Fiji"), ("d.ca", "Mali")]


def _lookups(spark):
    schema = "domain string, country_name string"
    return spark.createDataFrame(OFFICIAL, schema), spark.createDataFrame(MANUAL, schema)


def test_publisher_lookups(spark):
    pairs = publisher_lookup(*_lookups(spark))
    assert sorted(pairs.collect(), key=str) == sorted(set(OFFICIAL + MANUAL), key=str)
    single = one_country_per_domain(*_lookups(spark))
    assert sorted(single.collect()) == [("a.com", "Chile"), ("b.com", "Cuba"), ("d.ca", "Mali")]


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_add_publisher(spark, max_rows):
    urls = ["http://a.com/1", "http://b.com/1", "http://c.com/1", "http://d.ca", "http://e.ca", "http://f.com", "x", None]
    df = spark.createDataFrame([(u, "k") for u in urls], "SOURCEURL string, kept string")
    lookup = size_lookup(publisher_lookup(*_lookups(spark)), max_rows=max_rows)
    result = add_publisher(df, lookup)
    assert result.columns == ["SOURCEURL", "kept", "domain_name", "news_source_country"]
    got = sorted(((r[0], r[2], r[3]) for r in result.collect()), key=str)
    expected = [
        ("http://a.com/1", "a.com", "Chile"),
        ("http://b.com/1", "b.com", "Cuba"),
        ("http://b.com/1", "b.com", "Fiji"),
        ("http://b.com/1", "b.com", "Peru"),
        ("http://c.com/1", "c.com", "Unknown"),
        ("http://d.ca", "d.ca", "Mali"),
        ("http://e.ca", "e.ca", "Canada"),
        ("http://f.com", "f.com", "Unknown"),
        ("x", "", "Unknown"),
        (None, None, "Unknown"),
    ]
    assert got == sorted(expected, key=str)


def test_columns_named_like_the_lookup_survive(spark):
    df = spark.createDataFrame([("http://b.ca/1", "01", "d", "n", "c", "t")], (
        "SOURCEURL string, EventCode string, domain string, country_name string, code string, description string"
    ))
    publishers = size_lookup(spark.createDataFrame([("b.ca", "Peru")], "domain string, country_name string"))
    actions = size_lookup(spark.createDataFrame([("01", "SAY")], "code string, description string"))
    row = add_actions(add_publisher(df, publishers), actions).first()
    assert row[:8] == ("http://b.ca/1", "01", "d", "n", "c", "t", "b.ca", "Peru") and row.Cameo == "SAY"


def test_lookup_strategy_follows_size(spark):
    facts = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id"))
    lookup = spark.createDataFrame([("1", "one"), ("2", "two")], "key string, name string")
    sized = size_lookup(lookup)
    assert (sized.rows, sized.bytes) == (2, 8)
    near = left_lookup(facts, sized, F.col("k"), "key")
    far = left_lookup(facts, size_lookup(lookup, max_bytes=7), F.col("k"), "key")
    assert "BroadcastHashJoin" in _plan(near) and "Exchange hashpartitioning" not in _plan(near)
    assert "SortMergeJoin" in _plan(far) and _plan(far).count("Exchange hashpartitioning") == 2
    assert near.columns == far.columns == ["k", "id", "name"]
    assert sorted(near.collect(), key=str) == sorted(far.collect(), key=str)


def test_kept_lookup(spark):
    derived = spark.range(100).groupBy((F.col("id") % 3).cast("string").alias("key")).count()
    plain, kept = size_lookup(derived), size_lookup(derived, keep=True)
    assert (kept.rows, kept.bytes) == (plain.rows, plain.bytes) == (3, 9)
    assert "Range" not in _plan(kept.df) and sorted(kept.df.collect()) == sorted(derived.collect())
    assert size_lookup(derived.filter("count < 0"), keep=True).rows == 0


def test_a_hot_key_is_spread(spark):
    """A third of all rows have one key: Spark divides their partition by map output."""
    copy = F.col("id") % 3 == 0
    facts = spark.range(0, 30_000, 1, 16).select(
        F.when(copy, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("k"),
        F.when(copy, F.lit(None)).otherwise(F.col("id")).alias("n"),
        F.sha2(F.col("id").cast("string"), 512).alias("filler"),
    )
    names = [("hot", "x"), ("hot", "y"), ("k1", "z"), ("absent", "w")]
    table = spark.createDataFrame(names, "key string, name string")
    near = left_lookup(facts, size_lookup(table), F.col("k"), "key")
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    for name, value in sizes.items():
        spark.conf.set(name, value)
    try:
        far = left_lookup(facts, size_lookup(table, max_rows=0), F.col("k"), "key")
        assert far.columns == near.columns and far.count() == near.count() == 40_000
        assert far.exceptAll(near).isEmpty() and near.exceptAll(far).isEmpty()
        hot = far.withColumn("p", F.spark_partition_id()).collect()
        parts = Counter(r.p for r in hot if r.k == "hot" and r.name == "x")
        assert sum(parts.values()) == 10_000 and len(parts) > 4 and max(parts.values()) < 5000
    finally:
        for name in sizes:
            spark.conf.unset(name)


def test_shuffled_lookup_of_rows_with_maps(spark):
    a_map = F.create_map("id", "id")
    facts = spark.range(10).select(
        (F.col("id") % 2).cast("string").alias("k"), a_map.alias("m"), F.array(a_map).alias("ms"), F.struct(a_map.alias("m")).alias("s")
    )
    lookup = size_lookup(spark.createDataFrame([("1", "x")], "key string, name string"), max_rows=0)
    rows = left_lookup(facts, lookup, F.col("k"), "key").collect()
    assert sorted((r.k, r.name) for r in rows if r.name) == [("1", "x")] * 5 and len(rows) == 10


def test_null_safe_lookup(spark):
    facts = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    table = spark.createDataFrame([(None, 1), ("a", 2)], "key string, n int")
    for max_rows in (10, 0):
        lookup = size_lookup(table, max_rows=max_rows)
        plain = left_lookup(facts, lookup, F.col("k"), "key")
        safe = left_lookup(facts, lookup, F.col("k"), "key", null_safe=True)
        assert sorted(plain.collect(), key=str) == [("a", 2), ("b", None), (None, None)]
        assert sorted(safe.collect(), key=str) == [("a", 2), ("b", None), (None, 1)]


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_add_actions(spark, max_rows):
    codes = [("01", "STATE"), ("010", "State"), ("0211", "Ask"), ("10", "DEMAND"), ("1056", "Withdraw")]
    dictionary = size_lookup(spark.createDataFrame(codes, "code string, description string"), max_rows=max_rows)
    given = ["010", "0211", "5", "106", "1056", None, "999"]
    df = spark.createDataFrame([(c,) for c in given], "EventCode string")
    result = add_actions(df, dictionary)
    assert result.columns == ["EventCode", "Cameo", "Cameo_full"]
    assert {r[0]: (r[1], r[2]) for r in result.collect()} == {
        "010": ("STATE", "State"),
        "0211": (None, "Ask"),
        "5": (None, None),
        "106": ("DEMAND", None),
        "1056": ("DEMAND", "Withdraw"),
        None: (None, None),
        "999": (None, None),
    }
    other = spark.range(1)
    assert add_actions(other, dictionary) is other


def test_enrich_events(spark):
    known = {
        "GLOBALEVENTID": "1", "SQLDATE": "20230201", "Actor2Name": "AUSTRALIAN", "EventCode": "051",
        "SOURCEURL": "https://www.news.com.au/a",
    }
    other = {**known, "GLOBALEVENTID": "2", "Actor2Name": None, "Actor1Code": "australian"}
    raw = spark.createDataFrame([tuple(e.get(c) for c in RAW_COLUMNS) for e in (known, other)], RAW_SCHEMA)
    codes = [("05", "ENGAGE IN DIPLOMATIC COOPERATION"), ("051", "Praise or endorse")]
    actions = size_lookup(spark.createDataFrame(codes, "code string, description string"))
    publishers = size_lookup(spark.createDataFrame([("cbc.ca", "Canada")], "domain string, country_name string"))
    every = enrich_events(raw, publishers, actions)
    assert every.columns == KEEP_SHORT + ENRICHMENT_COLUMNS and every.count() == 2
    # The unselected Actor1Code is not searched.
    found = enrich_events(raw, publishers, actions, terms=["AUSTRALIAN"]).collect()
    assert [(r.GLOBALEVENTID, r.domain_name, r.news_source_country) for r in found] == [("1", "news.com.au", "Australia")]
    assert (found[0].Cameo, found[0].Cameo_full) == codes[0][1:] + codes[1][1:]
    assert "Exchange hashpartitioning" not in _plan(every)


MANIFEST = """1234567 20240101.export.CSV.zip

  2500000\t20240102.export.CSV.zip
n/a 20240103.export.CSV.zip
1 2 20240104.export.CSV.zip
900 20241399.export.CSV.zip
900 2006.zip
900 200601.zip
single
5000000 20240105.export.CSV.zip"""


def _manifest(spark):
    return spark.createDataFrame([(line,) for line in MANIFEST.split("\n")], "value string")


def test_parse_manifest(spark):
    listed = parse_manifest(_manifest(spark))
    assert listed.dtypes == [("id", "bigint"), ("FileSizeMB", "double"), ("FileName", "string"), ("Date", "date")]
    rows = listed.orderBy("Date").collect()
    assert [(r.FileSizeMB, r.FileName, r.Date.day) for r in rows] == [
        (1.23, "20240101.export.CSV.zip", 1),
        (2.5, "20240102.export.CSV.zip", 2),
        (None, "20240103.export.CSV.zip", 3),
        (5.0, "20240105.export.CSV.zip", 5),
    ]
    assert len({r.id for r in rows}) == 4
    assert manifest_rejects(_manifest(spark)).collect() == [(2, 1, 1)]


def test_sizes_and_bounds(spark):
    listed = parse_manifest(_manifest(spark))
    assert total_size(listed, dt.date(2024, 1, 1), "2024-01-03") == 3.73
    assert total_size(listed, "2024-01-03", "2024-01-03") == 0
    assert range_size(listed, "2024-01-04", "2024-01-05").first() == (False, True, 5.0)
    with pytest.raises(ValueError, match="2024-01-04"):
        total_size(listed, "2024-01-04", "2024-01-05")
    with pytest.raises(ValueError, match="2020-01-01, 2021-01-01"):
        total_size(listed, "2020-01-01", "2021-01-01")
    assert range_size(listed.limit(0), "2024-01-01", "2024-01-01").first() == (False, False, 0.0)


def test_download_plan(spark):
    plan = download_plan(parse_manifest(_manifest(spark)), "2024-01-02", "2024-01-03", "http://h/", "/d")
    assert plan.columns == ["id", "FileSizeMB", "filename", "Date", "date_str", "file_url", "local_filepath"]
    rows = plan.orderBy("Date").collect()
    name = "20240102.export.CSV.zip"
    assert rows[0][2:] == (name, dt.date(2024, 1, 2), "20240102", f"http://h/{name}", f"/d/{name}")
    assert len(rows) == 2


def test_plan_chunks(spark):
    ranges = spark.createDataFrame(
        [(dt.date(2024, 1, 1), dt.date(2024, 1, 12)), (dt.date(2024, 2, 2), dt.date(2024, 2, 1)), (None, None)],
        "start_date date, end_date date",
    )
    rows = plan_chunks(ranges, 5).orderBy("chunk").collect()
    assert [(r.chunk, r.chunk_start.day, r.chunk_end.day) for r in rows] == [(0, 1, 5), (1, 6, 10), (2, 11, 12)]
    single = plan_chunks(ranges, 30).collect()
    assert [(r.chunk_start.day, r.chunk_end.day) for r in single] == [(1, 12)]
    with pytest.raises(ValueError):
        plan_chunks(ranges, 0)


def test_many_terms_equal_few(spark):
    from tidings.operators import filter_many_terms

    rows = [(1, "The Quick fox", None), (2, None, "x%y"), (3, "", ""), (4, "é É", "ab"), (5, "a", "b"), (6, "nothing", "else")]
    df = spark.createDataFrame(rows, "id long, u string, searched string")
    for terms in (["quick", "%Y", "é"], ["ab"], ["zz"], [""], [], [f"no{i}" for i in range(3000)] + ["FOX"]):
        for columns in (["u", "searched", "absent"], ["absent"], []):
            many, few = (sorted(map(tuple, f(df, terms, columns).collect())) for f in (filter_many_terms, filter_terms))
            assert many == few
    with pytest.raises(ValueError):
        filter_many_terms(df, ["abc", "def"], ["u"], max_characters=5)
