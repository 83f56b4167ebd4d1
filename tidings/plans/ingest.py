"""From a date range to a compact, enriched table."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidings.files import delete, names
from tidings.loads import FILE_DATE, commit_load, compact_changed, read_snapshot, write_observed
from tidings.operators import SizedLookup, download_plan, plan_chunks, status_counts
from tidings.plans.enrich import enrich_events
from tidings.schema import KEEP_SHORT, RAW_COLUMNS, SEARCH_COLUMNS
from tidings.shared import new_folder
from tidings.sinks import compact_table
from tidings.sources import archive_events, expand_archives, fetch_files, http_get, read_events
from tidings.sources.archives import BAD_ZIP, OK
from tidings.sources.fetch import missing_files


@dataclass(frozen=True)
class Loaded:
    """What a load has done: rows written, dates replaced, and damaged archives, whose dates keep
    the rows they had. ``statuses`` counts the downloads of a whole job, ``rejected`` the lines of plain
    files with too many or too few fields."""

    rows: int = 0
    dates: list[dt.date] = field(default_factory=list)
    damaged: list[str] = field(default_factory=list)
    statuses: DataFrame | None = None
    rejected: int = 0

    def __add__(self, other: Loaded) -> Loaded:
        rows, rejected = self.rows + other.rows, self.rejected + other.rejected
        return Loaded(rows, self.dates + other.dates, self.damaged + other.damaged, self.statuses, rejected)


def fetch_range(
    manifest: DataFrame,
    start: dt.date,
    end: dt.date,
    base_url: str,
    landing: str,
    status_path: str,
    fetch: Callable[[str], Iterable[bytes]] = http_get,
    tasks: int | None = None,
    resume: bool = False,
    attempts: int = 1,
) -> DataFrame:
    """Download the files of a date range and count them per status.

    The outcomes are written once, to a folder of their own below ``status_path`` that names the
    range, and counted from there, so nothing is downloaded a second time. Outcomes of other
    ranges stay. With ``resume`` files that have landed complete are left out of the plan and counted
    as ``SKIPPED: Landed`` (see :func:`~tidings.sources.fetch.missing_files`).
    """
    spark = manifest.sparkSession
    plan = download_plan(manifest, start, end, base_url, landing)
    path = f"{status_path.rstrip('/')}/range={start}_{end}"
    missing, landed = missing_files(plan, landing, status_path) if resume else (plan, plan.limit(0))
    fetched = fetch_files(missing, fetch, tasks, attempts=attempts)
    outcomes = new_folder(spark, "outcomes")
    skipped = landed.withColumn("download_status", F.lit("SKIPPED: Landed"))
    fetched.unionByName(skipped, allowMissingColumns=True).write.parquet(outcomes)
    # Outcomes of an earlier run of the range are read until the new ones are there.
    spark.read.schema(fetched.schema).parquet(outcomes).write.mode("overwrite").parquet(path)
    delete(spark, outcomes)
    return status_counts(spark.read.schema(fetched.schema).parquet(path))


def _named_date(name: str) -> dt.date | None:
    """The date of a daily file named ``yyyyMMdd.*``."""
    stem = name.rsplit("/", 1)[-1].split(".", 1)[0]
    try:
        return dt.datetime.strptime(stem, "%Y%m%d").date() if re.fullmatch("[0-9]{8}", stem) else None
    except ValueError:
        return None


def _landed_dates(spark: SparkSession, path: str, start: dt.date, end: dt.date, suffix: str) -> list[dt.date]:
    """Dates in a range of the files in ``path``, empty ones included, from the listing alone."""
    days = {_named_date(name) for name in names(spark, path) if name.lower().endswith(suffix)}
    return sorted(day for day in days if day and start <= day <= end)


def _committed(
    spark: SparkSession, enriched: DataFrame, table: str, load: str, dates: list[dt.date], filled: set[dt.date]
) -> int:
    """Put the load in the place of all ``dates`` in one step; returns its number of rows, from file footers."""
    now = commit_load(spark, table, load, enriched.schema, dates, filled)
    return read_snapshot(spark, table, now, [d.isoformat() for d in filled.intersection(dates)]).count()


def ingest_files(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    landing: str,
    table: str,
    publishers: SizedLookup,
    actions: SizedLookup,
    columns: Sequence[str] = KEEP_SHORT,
    terms: Sequence[str] = (),
    search_columns: Sequence[str] = SEARCH_COLUMNS,
    headers: Sequence[str] = RAW_COLUMNS,
    encoding: str = "UTF-8",
) -> Loaded:
    """Enrich the landed plain event files of a date range into ``table``.

    ``table`` is partitioned by the date in the file's name. The dates of the range's files are
    replaced, also by nothing, in one step (see ``tidings.loads``); other dates stay as they are. Files
    without a date are not read. Lines with too many or too few fields are loaded as far as they go, and counted.
    """
    dates = _landed_dates(spark, landing, start, end, ".csv")
    if not dates:
        return Loaded()
    rejects = Observation()
    events = read_events(spark, landing, headers, encoding, FILE_DATE, rejected_column="rejected_line")
    events = events.where(F.col(FILE_DATE).isin(dates)).observe(rejects, F.count("rejected_line").alias("n"))
    events = events.drop("rejected_line")
    enriched = enrich_events(events, publishers, actions, columns, terms, search_columns, carry=[FILE_DATE])
    load, filled = write_observed(enriched, table)
    rows = _committed(spark, enriched, table, load, dates, filled)
    return Loaded(rows, dates, rejected=rejects.get["n"])


def ingest_archives(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    landing: str,
    table: str,
    publishers: SizedLookup,
    actions: SizedLookup,
    columns: Sequence[str] = KEEP_SHORT,
    terms: Sequence[str] = (),
    search_columns: Sequence[str] = SEARCH_COLUMNS,
    headers: Sequence[str] = RAW_COLUMNS,
    encoding: str = "UTF-8",
) -> Loaded:
    """Enrich the landed archives of a date range into ``table``.

    ``table`` is partitioned by the date in the archive's name, whatever its members are called.
    The dates of the range's archives are replaced, also by nothing; other dates stay as they are,
    and so does a date with a damaged archive, which is reported. Archives are read once and rows
    are written once; the load is put in place when it is known which archives were whole.
    """
    if not _landed_dates(spark, landing, start, end, ".zip"):
        return Loaded()
    try:
        lines = expand_archives(spark, landing, encoding, dates=(start, end))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return Loaded()  # nothing has landed yet
    states = Observation()
    archive = F.when(F.col("member").isNull(), F.col("archive"))
    watched = lines.observe(
        states,
        F.collect_set(F.when(F.col("status") == OK, archive)).alias("whole"),
        F.collect_set(F.when(F.col("status") == BAD_ZIP, archive)).alias("damaged"),
    )
    events = archive_events(watched, headers, FILE_DATE)
    enriched = enrich_events(events, publishers, actions, columns, terms, search_columns, carry=[FILE_DATE])
    load, filled = write_observed(enriched, table)
    whole, damaged = ({path: _named_date(path) for path in states.get[k] or []} for k in ("whole", "damaged"))
    dates = sorted({d for d in whole.values() if d} - set(damaged.values()))
    broken = sorted(path.rsplit("/", 1)[1] for path in damaged)
    return Loaded(_committed(spark, enriched, table, load, dates, filled), dates, broken)


def run_ingest(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    manifest: DataFrame,
    base_url: str,
    landing: str,
    status_path: str,
    table: str,
    publishers: SizedLookup,
    actions: SizedLookup,
    columns: Sequence[str] = KEEP_SHORT,
    terms: Sequence[str] = (),
    search_columns: Sequence[str] = SEARCH_COLUMNS,
    headers: Sequence[str] = RAW_COLUMNS,
    encoding: str = "UTF-8",
    compacted: str | None = None,
    num_files: int | None = None,
    chunk_days: int | None = None,
    download_only: bool = False,
    fetch: Callable[[str], Iterable[bytes]] = http_get,
    tasks: int | None = None,
    resume: bool = False,
    attempts: int = 1,
) -> Loaded:
    """Fetch, enrich, store and optionally compact a date range.

    Returns the counts by download status, the rows stored, the dates replaced and the damaged
    archives. The range is fetched and loaded as a whole, which lets Spark spread all files at once.
    ``chunk_days`` loads it window by window instead, for a landing area read in turns. The
    compact copy has ``num_files`` files, or stays partitioned by file date if none is given: then
    only dates that have changed are written again. With ``resume`` files that have landed are not
    fetched again, and ``attempts`` bounds the tries of a file.
    """
    if start > end:
        raise ValueError("the start date cannot be after the end date")
    result = Loaded(statuses=fetch_range(manifest, start, end, base_url, landing, status_path, fetch, tasks, resume, attempts))
    if download_only:
        return result
    windows = [(start, end)]
    if chunk_days:
        bounds = spark.createDataFrame([(start, end)], "start_date date, end_date date")
        chunks = plan_chunks(bounds, chunk_days).orderBy("chunk").select("chunk_start", "chunk_end")
        windows = [tuple(row) for row in chunks.collect()]
    for first, last in windows:
        result += ingest_archives(
            spark, first, last, landing, table, publishers, actions, columns, terms, search_columns, headers, encoding
        )
    if compacted and result.dates:
        if num_files:
            compact_table(spark, table, compacted, num_files)
        else:
            compact_changed(spark, table, compacted)
    return result
