"""Tables whose loads are one step.

A load writes its rows once, into folders of its own below the dates (``file_date=.../load_id=...``), where
no reader looks yet. One small record beside the table then says which load each date has; the
newest complete record is the table. So a reader sees the dates before a load or after it, never both, and a
load that is killed leaves either nothing that counts or a finished step. What a killed load has
written is undone by the next one; folders that a load has replaced go with the load after it, so
that readers of the record before can finish.

A table has one loading job at a time; a second one that commits the same record fails.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidings import files

FILE_DATE = "file_date"
LOAD = "load_id"
_RECORDS = "_loads"
_RECORD, _BEGUN = re.compile(r"(\d{8})\.json"), re.compile(r"(\w+)\.begun")


@dataclass(frozen=True)
class Snapshot:
    """A table at one record: the load of each date, the columns, and, of a compact copy, the load of
    the origin that each date was made from."""

    version: int = 0
    loads: dict[str, str] = field(default_factory=dict)
    schema: dict | None = None
    sources: dict[str, str] = field(default_factory=dict)


def _folder(table: str, date: str, load: str) -> str:
    return f"{table.rstrip('/')}/{FILE_DATE}={date}/{LOAD}={load}"


def _records(spark: SparkSession, table: str) -> tuple[list[Snapshot], int]:
    """Complete records, the newest first, and the highest number that a record has had."""
    found, highest = [], 0
    for name in reversed(files.names(spark, f"{table.rstrip('/')}/{_RECORDS}")):
        if match := _RECORD.fullmatch(name):
            highest = max(highest, int(match[1]))
            try:
                found.append(Snapshot(int(match[1]), **json.loads(files.read_text(spark, f"{table.rstrip('/')}/{_RECORDS}/{name}"))))
            except ValueError:
                continue  # a job was killed while it wrote this record: it does not count
    return found, highest


def snapshot(spark: SparkSession, table: str) -> Snapshot | None:
    """The newest complete record of ``table``; None if it has no loads."""
    found, _ = _records(spark, table)
    return found[0] if found else None


def read_snapshot(spark: SparkSession, table: str, held: Snapshot, dates: Iterable[str] | None = None) -> DataFrame:
    """The rows of ``table`` as the record ``held`` has them, of all dates or of some."""
    schema = StructType.fromJson(held.schema)
    paths = [_folder(table, d, load) for d, load in sorted(held.loads.items()) if dates is None or d in set(dates)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(*paths).select(schema.names)


def undo_unfinished(spark: SparkSession, table: str) -> list[str]:
    """Remove what killed loads have left; returns their names. A load that has its record stays."""
    root, gone = table.rstrip("/"), []
    begun = [m[1] for m in map(_BEGUN.fullmatch, files.names(spark, f"{root}/{_RECORDS}")) if m]
    held = snapshot(spark, table) or Snapshot()
    for load in begun:
        if load not in held.loads.values():
            for name in files.names(spark, root):
                if name.startswith(f"{FILE_DATE}="):
                    files.delete(spark, f"{root}/{name}/{LOAD}={load}")
            gone.append(load)
        files.delete(spark, f"{root}/{_RECORDS}/{load}.begun")
    return gone


def write_load(df: DataFrame, table: str) -> str:
    """Write the rows of ``df`` as a load that no reader sees yet; returns its name.

    Rows go to the folders of their file_date, which must not be null, by the tasks that hold them, so
    that a very large day is written in parallel.
    """
    spark, root = df.sparkSession, table.rstrip("/")
    undo_unfinished(spark, table)
    if snapshot(spark, table) is None and any(n.startswith(f"{FILE_DATE}=") for n in files.names(spark, root)):
        raise ValueError(f"{table} has dates without a record of loads")
    load = f"l{uuid.uuid4().hex}"
    files.create_text(spark, f"{root}/{_RECORDS}/{load}.begun", "")
    df.withColumn(LOAD, F.lit(load)).write.mode("append").partitionBy(FILE_DATE, LOAD).parquet(root)
    return load


def commit_load(
    spark: SparkSession,
    table: str,
    load: str,
    schema: StructType,
    dates: Iterable[dt.date],
    filled: Iterable[dt.date],
    sources: dict[str, str] | None = None,
) -> Snapshot:
    """Put ``load`` in the place of all ``dates``, in one step: those in ``filled`` have its rows, the others none.

    Rows that the load has written for further dates do not count. ``sources`` are kept with the record.
    """
    root = table.rstrip("/")
    records, highest = _records(spark, table)
    before = records[0] if records else Snapshot()
    replaced, full = {d.isoformat() for d in dates}, {d.isoformat() for d in filled}
    loads = {d: x for d, x in before.loads.items() if d not in replaced} | {d: load for d in full & replaced}
    now = Snapshot(highest + 1, loads, schema.jsonValue(), sources or {})
    text = json.dumps({"loads": loads, "schema": now.schema, "sources": now.sources}, sort_keys=True)
    files.create_text(spark, f"{root}/{_RECORDS}/{now.version:08d}.json", text)
    # The load is there. What follows only removes; a job killed here leaves it to the next load.
    for d in full - replaced:
        files.delete(spark, _folder(table, d, load))
    for old in records[1:]:
        for d, x in old.loads.items():
            if x not in (loads.get(d), before.loads.get(d)):
                files.delete(spark, _folder(table, d, x))
                if not files.names(spark, f"{root}/{FILE_DATE}={d}"):
                    files.delete(spark, f"{root}/{FILE_DATE}={d}")
        files.delete(spark, f"{root}/{_RECORDS}/{old.version:08d}.json")
    files.delete(spark, f"{root}/{_RECORDS}/{load}.begun")
    return now


def write_observed(df: DataFrame, table: str) -> tuple[str, set[dt.date]]:
    """The rows of ``df`` as a load without effect yet, and the dates that it has rows of."""
    seen = Observation()
    load = write_load(df.observe(seen, F.collect_set(FILE_DATE).alias("dates")), table)
    return load, set(seen.get["dates"] or [])


def load_dates(df: DataFrame, table: str, dates: Iterable[dt.date] = ()) -> Snapshot:
    """Put the rows of ``df`` in the place of their dates, in one step; further ``dates`` are emptied in the same step.

    The file_date must not be null. Rows are written once, by the tasks that hold them.
    """
    load, filled = write_observed(df, table)
    return commit_load(df.sparkSession, table, load, df.schema, filled.union(dates), filled)


def derive_changed(
    spark: SparkSession, origin: str, destination: str, derive: Callable[[DataFrame], DataFrame]
) -> list[dt.date]:
    """Bring ``destination``, made by ``derive`` from the loaded table ``origin``, up to date; returns the dates rewritten.

    The result remembers which load each of its dates was made from. Only dates that have another load
    since are read, and what ``derive`` makes of their rows is written as one load of the
    result; dates that are gone go there too; all others keep their files. ``derive`` must treat
    each file_date by itself and keep the column; a date may end without rows.
    """
    if origin.rstrip("/") == destination.rstrip("/"):
        raise ValueError("a table cannot be derived onto itself")
    now, held = snapshot(spark, origin) or Snapshot(), snapshot(spark, destination) or Snapshot()
    changed = {d for d, load in now.loads.items() if held.sources.get(d) != load}
    gone = held.loads.keys() - now.loads.keys()
    if not changed and not gone:
        return []
    rows = derive(read_snapshot(spark, origin, now, changed))
    load, filled = write_observed(rows.hint("rebalance", FILE_DATE), destination)
    dates = {d: dt.date.fromisoformat(d) for d in changed | gone}
    commit_load(spark, destination, load, rows.schema, dates.values(), filled, now.loads)
    return sorted(dates[d] for d in changed)


def compact_changed(spark: SparkSession, origin: str, destination: str) -> list[dt.date]:
    """Bring ``destination``, a compact copy of the loaded table ``origin``, up to date; returns the dates rewritten.

    The rows of dates that have another load since are packed into files of Spark's advisory
    partition size (see :func:`derive_changed`).
    """
    return derive_changed(spark, origin, destination, lambda rows: rows)
