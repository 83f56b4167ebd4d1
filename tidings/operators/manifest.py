"""File manifest: parsing, date ranges, sizes and the download plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions import file_date

# Fixed value: how daily archives are named.
ARCHIVE_SUFFIX = ".export.CSV.zip"

DateLike = dt.date | str


def _tokens(lines: DataFrame) -> DataFrame:
    return lines.select(F.regexp_extract_all("value", F.lit(r"\S+"), 0).alias("token"))


def parse_manifest(lines: DataFrame) -> DataFrame:
    """Daily files listed by ``size name`` lines in column ``value``.

    Returns ``id, FileSizeMB, FileName, Date``. Lines that do not have exactly two tokens
    are dropped (``manifest_rejects`` counts them), as are files without a daily date. A
    size that is not a number gives NULL. ``id`` is unique but otherwise arbitrary.
    """
    name = F.try_element_at("token", F.lit(2))
    size = F.try_element_at("token", F.lit(1)).try_cast("float")
    listed = _tokens(lines).select(
        (F.size("token") == 2).alias("complete"),
        F.round(size * F.lit(1e-6), 2).alias("FileSizeMB"),
        name.alias("FileName"),
        file_date(name).alias("Date"),
    )
    # As a generator the test is not moved below the parsing, which would parse each line
    # once more for every condition on a parsed column.
    files = F.when(
        F.col("complete") & F.col("Date").isNotNull(), F.array(F.struct("FileSizeMB", "FileName", "Date"))
    )
    return listed.select(F.inline(files)).select(F.monotonically_increasing_id().alias("id"), "*")


def manifest_rejects(lines: DataFrame) -> DataFrame:
    """One row that counts what ``parse_manifest`` drops or cannot read.

    ``rejected``: non-blank lines that do not split in two; ``undated``: names that begin with eight
    digits which are no date; ``unsized``: daily files whose size is not a number.
    """
    malformed = (F.size("token") != 2) & (F.size("token") > 0)
    name = F.try_element_at("token", F.lit(2))
    pair, date = F.size("token") == 2, file_date(name)
    sized = F.try_element_at("token", F.lit(1)).try_cast("float").isNotNull()
    return _tokens(lines).agg(
        F.count_if(malformed).alias("rejected"),
        F.count_if(pair & date.isNull() & F.rlike(name, F.lit(r"^[0-9]{8}\."))).alias("undated"),
        F.count_if(pair & date.isNotNull() & ~sized).alias("unsized"),
    )


def _as_date(value: DateLike) -> Column:
    return F.lit(value).cast("date")


def in_date_range(manifest: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Files dated from ``start`` to ``end``, both included."""
    return manifest.filter(F.col("Date").between(_as_date(start), _as_date(end)))


def range_size(manifest: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """One row ``start_exists, end_exists, total_mb`` for a date range, in a single pass."""
    first, last = _as_date(start), _as_date(end)
    inside = F.when(F.col("Date").between(first, last), F.col("FileSizeMB"))
    return manifest.agg(
        F.coalesce(F.bool_or(F.col("Date") == first), F.lit(False)).alias("start_exists"),
        F.coalesce(F.bool_or(F.col("Date") == last), F.lit(False)).alias("end_exists"),
        F.round(F.coalesce(F.sum(inside), F.lit(0.0)), 2).alias("total_mb"),
    )


def total_size(manifest: DataFrame, start: DateLike, end: DateLike) -> float:
    """Megabytes listed in a date range; ValueError when a boundary date has no file."""
    row = range_size(manifest, start, end).first()
    absent = [
        str(bound)
        for bound, exists in ((start, row["start_exists"]), (end, row["end_exists"]))
        if not exists
    ]
    if absent:
        raise ValueError(f"no file in the manifest for boundary date(s): {', '.join(absent)}")
    return row["total_mb"]


def download_plan(
    manifest: DataFrame, start: DateLike, end: DateLike, base_url: str, output_dir: str
) -> DataFrame:
    """Manifest rows of a date range with ``date_str, filename, file_url, local_filepath``.

    The file name is rebuilt from the date and takes the place of the listed ``FileName``.
    """
    # The names of the added columns.
    day = F.date_format("Date", "yyyyMMdd")
    name = F.concat(day, F.lit(ARCHIVE_SUFFIX))
    return in_date_range(manifest, start, end).select(
        "id",
        "FileSizeMB",
        name.alias("filename"),
        "Date",
        day.alias("date_str"),
        F.concat(F.lit(base_url), name).alias("file_url"),
        F.concat(F.lit(output_dir), F.lit("/"), name).alias("local_filepath"),
    )
