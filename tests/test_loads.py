"""One-step loads: what readers see when a job is killed, and what is left behind."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidings import files, loads
from tidings.loads import (
    commit_load,
    compact_changed,
    derive_changed,
    load_dates,
    read_snapshot,
    snapshot,
    undo_unfinished,
    write_load,
)
from tidings.operators import merge_articles
from tidings.plans import update_article_states
from tidings.sinks import load_table
from tidings.sources import read_table

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]


def _rows(spark, *pairs):
    return spark.createDataFrame([(v, DAYS[d]) for d, v in pairs], "v string, file_date date")


def _load(spark, table, dates, *pairs):
    rows = _rows(spark, *pairs)
    load = write_load(rows, table)
    return commit_load(spark, table, load, rows.schema, [DAYS[d] for d in dates], {DAYS[d] for d, _ in pairs})


def _seen(spark, table):
    return sorted((r.file_date.day - 1, r.v) for r in read_table(spark, table).collect())


def _files(table):
    return sorted(os.path.relpath(os.path.join(d, f), table) for d, _, names in os.walk(table) for f in names if f.endswith(".parquet"))


def test_a_load_replaces_its_dates_and_empties_those_without_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    _load(spark, table, [0, 1, 2], (0, "a"), (1, "b"), (2, "c"))
    _load(spark, table, [1, 2, 3], (1, "x"), (3, "y"), (0, "of no effect"))
    assert _seen(spark, table) == [(0, "a"), (1, "x"), (3, "y")]
    assert read_table(spark, table).columns == ["v", "file_date"]
    _load(spark, table, [0, 1, 3])
    assert _seen(spark, table) == [] and read_table(spark, table).columns == ["v", "file_date"]


def test_a_job_killed_before_its_record_leaves_the_table_as_it_was(spark, tmp_path):
    table = str(tmp_path / "t")
    _load(spark, table, [0, 1], (0, "a"), (1, "b"))
    kept = _files(table)
    write_load(_rows(spark, (1, "lost"), (3, "lost")), table)  # and then the job is gone
    assert _seen(spark, table) == [(0, "a"), (1, "b")] and len(_files(table)) == 4
    _load(spark, table, [2], (2, "c"))
    assert _seen(spark, table) == [(0, "a"), (1, "b"), (2, "c")]
    assert set(kept) < set(_files(table)) and len(_files(table)) == 3
    assert [n for n in os.listdir(f"{table}/_loads") if n.endswith(".begun")] == []


def test_a_job_killed_after_its_record_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    _load(spark, table, [0], (0, "old"))
    _load(spark, table, [0], (0, "older"))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(files, "delete", killed)
        with pytest.raises(KeyboardInterrupt):
            _load(spark, table, [0, 1], (0, "new"), (1, "n"))
    assert _seen(spark, table) == [(0, "new"), (1, "n")]
    assert undo_unfinished(spark, table) == []
    _load(spark, table, [1], (1, "m"))
    assert _seen(spark, table) == [(0, "new"), (1, "m")]


def test_a_torn_record_does_not_count(spark, tmp_path):
    table = str(tmp_path / "t")
    _load(spark, table, [0], (0, "a"))
    load = write_load(_rows(spark, (0, "torn")), table)
    (tmp_path / "t" / "_loads" / "00000002.json").write_text('{"loads": {"2024-01-01": "' + load)
    assert _seen(spark, table) == [(0, "a")]
    assert _load(spark, table, [1], (1, "b")).version == 3
    assert _seen(spark, table) == [(0, "a"), (1, "b")] and len(_files(table)) == 2


def test_readers_of_the_record_before_can_finish(spark, tmp_path):
    table = str(tmp_path / "t")
    _load(spark, table, [0], (0, "a"))
    held = read_table(spark, table)
    _load(spark, table, [0], (0, "b"))
    assert [r.v for r in held.collect()] == ["a"] and _seen(spark, table) == [(0, "b")]
    _load(spark, table, [0], (0, "c"))
    assert len(_files(table)) == 2  # of this record and of the one before


def test_two_jobs_do_not_commit_the_same_record(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    _load(spark, table, [0], (0, "a"))
    old = loads._records(spark, table)
    _load(spark, table, [0], (0, "b"))
    rows = _rows(spark, (0, "late"))
    load = write_load(rows, table)
    monkeypatch.setattr(loads, "_records", lambda *_: old)
    with pytest.raises(FileExistsError):
        commit_load(spark, table, load, rows.schema, [DAYS[0]], [DAYS[0]])
    monkeypatch.undo()
    assert _seen(spark, table) == [(0, "b")]


def test_rows_are_written_once(spark, tmp_path):
    table, counted = str(tmp_path / "t"), spark.sparkContext.accumulator(0)
    rows = spark.range(0, 1000, 1, 4).withColumn("file_date", F.lit(DAYS[0]))

    def count(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    passed = rows.mapInArrow(count, rows.schema)
    load = write_load(passed, table)
    commit_load(spark, table, load, rows.schema, [DAYS[0]], [DAYS[0]])
    assert counted.value == 1000 and read_table(spark, table).count() == 1000
    assert all(f"load_id={load}" in f for f in _files(table))


def test_tables_of_other_making_are_not_taken_over(spark, tmp_path):
    load_table(_rows(spark, (0, "a")), str(tmp_path / "t"))
    with pytest.raises(ValueError):
        write_load(_rows(spark, (0, "b")), str(tmp_path / "t"))
    assert snapshot(spark, str(tmp_path / "t")) is None and read_table(spark, str(tmp_path / "t")).count() == 1


def test_only_changed_dates_are_compacted(spark, tmp_path):
    table, copy = str(tmp_path / "t"), str(tmp_path / "copy")
    many = spark.range(0, 4000, 1, 8).select(F.col("id").cast("string").alias("v"), F.lit(DAYS[0]).alias("file_date"))
    rows = many.unionByName(_rows(spark, (1, "b"), (2, "c")))
    commit_load(spark, table, write_load(rows, table), rows.schema, DAYS[:3], DAYS[:3])
    assert compact_changed(spark, table, copy) == DAYS[:3]
    first = _files(copy)
    assert len(first) == 3 and len(_files(table)) >= 10
    assert compact_changed(spark, table, copy) == [] and _files(copy) == first
    _load(spark, table, [1, 2, 3], (1, "x"), (3, "y"))
    assert compact_changed(spark, table, copy) == [DAYS[1], DAYS[3]]
    now = read_snapshot(spark, copy, snapshot(spark, copy))
    assert now.exceptAll(read_table(spark, table)).isEmpty() and now.count() == 4002
    assert {f for f in first if "01-01" in f} == {f for f in _files(copy) if "01-01" in f}
    assert not any("01-03" in f for f in now.inputFiles())
    with pytest.raises(ValueError):
        compact_changed(spark, table, f"{table}/")


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "x" / "a.json")
    files.create_text(spark, path, "h\xe9\n")
    assert files.read_text(spark, path) == "h\xe9\n" and files.names(spark, str(tmp_path / "x")) == ["a.json"]
    with pytest.raises(FileExistsError):
        files.create_text(spark, path, "other")
    files.delete(spark, str(tmp_path / "x"))
    files.delete(spark, str(tmp_path / "x"))
    assert files.names(spark, str(tmp_path / "x")) == []


def _article_day(spark, day, *tones):
    rows = [(str(i), f"2024010{day + 1}", "u" if i % 2 else None, t, t, DAYS[day]) for i, t in enumerate(tones)]
    columns = "GLOBALEVENTID string, SQLDATE string, SOURCEURL string, GoldsteinScale string, AvgTone string, file_date date"
    return spark.createDataFrame(rows, columns)


def test_article_states_follow_the_dates_that_changed(spark, tmp_path):
    events, states = str(tmp_path / "events"), str(tmp_path / "states")

    def merged():
        return {r.SOURCEURL: tuple(r)[1:] for r in merge_articles(read_table(spark, states)).collect()}

    load_dates(_article_day(spark, 0, "1", "2").unionByName(_article_day(spark, 1, "3", "bad", "5")), events)
    assert update_article_states(spark, events, states) == DAYS[:2]
    assert merged() == {None: ("20240101", 3, 3.0, 3.0), "u": ("20240101", 2, 2.0, 2.0)}
    before = _files(states)
    assert update_article_states(spark, events, states) == [] and _files(states) == before

    load_dates(_article_day(spark, 1, "7"), events)
    assert update_article_states(spark, events, states) == [DAYS[1]]
    assert merged() == {None: ("20240101", 2, 4.0, 4.0), "u": ("20240101", 1, 2.0, 2.0)}
    kept = [f for f in before if "2024-01-01" in f]
    assert kept and set(kept) <= set(_files(states))

    load_dates(_article_day(spark, 0, "9").limit(0), events, [DAYS[0]])
    assert update_article_states(spark, events, states) == []
    assert merged() == {None: ("20240102", 1, 7.0, 7.0)}


def test_a_date_may_end_without_rows_in_what_is_derived(spark, tmp_path):
    origin, derived = str(tmp_path / "a"), str(tmp_path / "b")
    load_dates(_rows(spark, (0, "a"), (1, "b"), (1, "a")), origin)
    only_a = F.col("v") == "a"
    assert derive_changed(spark, origin, derived, lambda rows: rows.where(only_a)) == DAYS[:2]
    load_dates(_rows(spark, (1, "b")), origin)
    assert derive_changed(spark, origin, derived, lambda rows: rows.where(only_a)) == [DAYS[1]]
    assert _seen(spark, derived) == [(0, "a")]
    assert derive_changed(spark, origin, derived, lambda rows: rows.where(only_a)) == []
