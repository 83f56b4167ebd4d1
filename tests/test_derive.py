import os
import zipfile

import pytest

from tidings.sources import archive_events, archive_status, expand_archives
from workload.derive import cut_archives, write_daily_archives, write_daily_files

COLUMNS = ["n", "SQLDATE", "text"]


@pytest.fixture
def rows():
    """A day of several batches, days of few rows, empty and absent fields."""
    large = [(f"{n}", "20240105", None if n % 5 == 0 else "é€😀"[: n % 4]) for n in range(21_000)]
    return [*large, ("a", "20240106", "x"), ("b", "20240115", ""), ("b", "20240115", "")]


def _text(row):
    return "\t".join(cell or "" for cell in row)


def test_daily_archives_and_cut_copies(spark, tmp_path, rows):
    events = spark.createDataFrame(rows, "n string, SQLDATE string, text string").repartition(4)
    whole, cut, direct = (str(tmp_path / name) for name in ("whole", "cut", "direct"))
    write_daily_archives(events, whole, "events.csv", parts=2)
    days = {row[1] for row in rows}
    written = [name for name in os.listdir(whole) if name.endswith(".zip")]
    assert {name[:8] for name in written} == days
    held = []
    for name in written:
        with zipfile.ZipFile(f"{whole}/{name}") as archive:
            held += [(name[:8], line) for line in archive.read("events.csv").decode().split("\n")[:-1]]
    assert sorted(held) == sorted((row[1], _text(row)) for row in rows)

    cut_archives(spark, whole, cut, "5")
    assert sorted(os.listdir(cut)) == sorted(written)
    for name in written:
        copy, origin = ((tmp_path / folder / name).read_bytes() for folder in ("cut", "whole"))
        assert copy == origin if name[:8] == "20240106" else origin.startswith(copy) and 0 < len(copy) < len(origin)
    write_daily_archives(events, direct, "events.csv", damaged="5", parts=2)
    assert {n: os.path.getsize(f"{direct}/{n}") for n in written} == {n: os.path.getsize(f"{cut}/{n}") for n in written}
    for folder in (cut, direct):
        lines = expand_archives(spark, folder)
        states = {(os.path.basename(r.archive)[:8], r.status) for r in archive_status(lines).collect()}
        assert states == {("20240105", "BAD_ZIP"), ("20240106", "OK"), ("20240115", "BAD_ZIP")}
        assert [tuple(r) for r in archive_events(lines, COLUMNS).collect()] == [("a", "20240106", "x")]


def test_daily_files(spark, tmp_path, rows):
    events = spark.createDataFrame(rows, "n string, SQLDATE string, text string").repartition(3)
    write_daily_files(events, str(tmp_path / "plain"), parts=1)
    read = {p.name: p.read_text().split("\n")[:-1] for p in (tmp_path / "plain").glob("*.CSV")}
    assert {name[:8] for name in read} == {row[1] for row in rows}
    for day in ("20240105", "20240106", "20240115"):
        assert sorted(read[f"{day}.export.CSV"]) == sorted(_text(row) for row in rows if row[1] == day)
