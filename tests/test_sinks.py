import os

import pytest
from pyspark.sql import functions as F

from tidings.sinks import append_table, compact_table, load_table, write_events
from tidings.sinks.tables import stored_bytes
from tidings.sources import read_events, read_table


def _files(path):
    return [f for f in os.listdir(path) if f.endswith(".parquet")]


def test_append_keeps_both(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        append_table(spark.range(3), path)
    assert read_table(spark, path).count() == 6


def test_load_replaces_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "v string, d string")
    dated = rows.select("v", F.to_date("d").alias("file_date"))
    load_table(dated, path)
    load_table(dated.filter("v = 'b'").withColumn("v", F.lit("c")), path)
    load_table(dated.limit(0), path)
    assert sorted((r.v, r.file_date.day) for r in read_table(spark, path).collect()) == [("a", 1), ("c", 2)]
    plan = read_table(spark, path).filter("file_date = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_date" in plan


def test_compaction(spark, tmp_path):
    origin, merged = str(tmp_path / "t"), str(tmp_path / "m")
    for n in range(3):
        append_table(spark.range(n * 10, n * 10 + 10).repartition(4), origin)
    assert len(_files(origin)) == 12
    for options in ({"num_files": 1}, {"num_files": None}, {"num_files": 1, "shuffle": True}):
        assert compact_table(spark, origin, merged, **options) == 30
        assert len(_files(merged)) == 1
        assert sorted(r[0] for r in read_table(spark, merged).collect()) == list(range(30))
    assert compact_table(spark, origin, merged, 3, shuffle=True) == 30
    assert len(_files(merged)) == 3
    assert stored_bytes(spark, origin) == sum(os.path.getsize(f"{origin}/{f}") for f in _files(origin))


def test_compaction_of_nested_folders(spark, tmp_path):
    for n in range(2):
        append_table(spark.range(n, n + 1), str(tmp_path / "t" / f"run{n}"))
    assert compact_table(spark, str(tmp_path / "t"), str(tmp_path / "m"), recursive=True) == 2


def test_compaction_by_date(spark, tmp_path):
    offset = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).cast("int")
    dates = F.date_add(F.lit("2024-01-01").cast("date"), offset)
    rows = spark.range(0, 1000, 1, 8).select("id", dates.alias("file_date"))
    load_table(rows, str(tmp_path / "t"))
    assert len(_files(tmp_path / "t" / "file_date=2024-01-01")) == 8
    assert compact_table(spark, str(tmp_path / "t"), str(tmp_path / "m"), by="file_date") == 1000
    assert len(_files(tmp_path / "m" / "file_date=2024-01-01")) == 1
    assert read_table(spark, str(tmp_path / "m")).exceptAll(rows).isEmpty()


def test_compaction_splits_a_large_date(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 10 < 9, "2024-01-01").otherwise("2024-01-02").cast("date").alias("file_date"),
    )
    load_table(rows, str(tmp_path / "t"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        assert compact_table(spark, str(tmp_path / "t"), str(tmp_path / "m"), by="file_date") == 400_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(_files(tmp_path / "m" / "file_date=2024-01-01")) > 3
    assert read_table(spark, str(tmp_path / "m")).count() == 400_000


def test_compaction_guards(spark, tmp_path):
    append_table(spark.range(1), str(tmp_path / "t"))
    with pytest.raises(ValueError):
        compact_table(spark, str(tmp_path / "t"), f"{tmp_path}/t/")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        compact_table(spark, str(tmp_path / "absent"), str(tmp_path / "m"))
    assert read_table(spark, str(tmp_path / "t")).count() == 1


def test_text_formats(spark, tmp_path):
    rows = [("1", 'say "x", y', ["a", "b"], [("p", None)]), ("2", None, [], [])]
    df = spark.createDataFrame(rows, "id string, t string, l array<string>, s array<struct<u:string,v:string>>")
    write_events(df, str(tmp_path / "csv"), "csv")
    stored = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "csv"))
    assert sorted(stored.collect()) == [("1", 'say "x", y', "a;b", "p|"), ("2", None, None, None)]
    write_events(df.select("id", "t"), str(tmp_path / "tsv"), "tsv")
    assert sorted(read_events(spark, str(tmp_path / "tsv"), ["id", "t"]).collect()) == [("1", 'say "x", y'), ("2", None)]
    write_events(df, str(tmp_path / "pq"))
    assert read_table(spark, str(tmp_path / "pq")).schema == df.schema
    with pytest.raises(ValueError):
        write_events(df, str(tmp_path / "x"), "xml")
