"""Stored tables: append, repeatable load, compaction and delimited text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from tidings.files import delete
from tidings.loads import FILE_DATE
from tidings.sources.tables import read_table

TARGET_FILE_BYTES = 512 * 1024 * 1024

_UNTRIMMED = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Plain delimited text: no quoting and no escaping, NULL as the empty field.
_PLAIN = {
    "sep": "\t", "quote": "\u0000", "escapeQuotes": "false", "nullValue": "", "emptyValue": "", **_UNTRIMMED,
}


def append_table(df: DataFrame, path: str) -> None:
    """Append to an unpartitioned Parquet data set; loading the same rows twice keeps both."""
    df.write.mode("append").parquet(path)


def load_table(df: DataFrame, path: str, by: str = FILE_DATE) -> None:
    """Write Parquet partitioned by file date, replacing the dates that ``df`` has rows of.

    Dates without rows stay as they are (see :func:`drop_dates`), so ``by`` must not be NULL. Rows are written by the tasks
    that hold them, without a shuffle by date, so a very large day is written in parallel.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def drop_dates(spark: SparkSession, path: str, dates: Iterable[dt.date], by: str = FILE_DATE) -> None:
    """Remove the partitions of ``dates`` from a table of :func:`load_table`; absent ones are skipped."""
    for date in dates:
        delete(spark, f"{path.rstrip('/')}/{by}={date.isoformat()}")


def _joined(name: str, kind: DataType):
    column = F.col(name)
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        fields = kind.elementType.names
        column = F.transform(column, lambda item: F.concat_ws("|", *[F.coalesce(item[f], F.lit("")) for f in fields]))
    return F.array_join(column, ";").alias(name) if isinstance(kind, ArrayType) else column


def write_events(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", by: str | None = None
) -> None:
    """Write ``df`` as Parquet, as CSV with a header, or as the plain TSV that ``read_events`` reads.

    ``by`` names a partition column.

    CSV and TSV cannot hold arrays: their elements are joined by ';', struct fields by '|'.
    """
    if fmt not in ("parquet", "csv", "tsv"):
        raise ValueError(f"unknown format: {fmt}")
    flat = df if fmt == "parquet" else df.select(*[_joined(f.name, f.dataType) for f in df.schema.fields])
    writer = flat.write.mode(mode).partitionBy(*([by] if by else []))
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        writer.option("header", True).options(**_UNTRIMMED).csv(path)
    else:
        writer.options(**_PLAIN).csv(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the Parquet files below ``path``, from the file listing alone."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet")
    return files.load(path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def compact_table(
    spark: SparkSession,
    origin: str,
    destination: str,
    num_files: int | None = None,
    recursive: bool = False,
    shuffle: bool = False,
    fmt: str = "parquet",
    by: str | None = None,
) -> int:
    """Rewrite a Parquet data set into few files and return its number of rows.

    The number of files follows from the stored size, for files of about 512 MB; ``num_files``
    asks for another, such as 1 for a small table.
    Without ``shuffle`` neighbouring input is merged in place, which moves no data between
    executors but cannot make more files than there are input splits. ``by`` keeps a table
    partitioned by that column instead: Spark packs each value into files of its advisory
    partition size and splits a value that is larger, so no value is written by one task
    alone. ``destination`` is replaced; it must not be ``origin``.
    """
    if origin.rstrip("/") == destination.rstrip("/"):
        raise ValueError("a table cannot be compacted onto itself")
    if num_files is None and not by:
        num_files = max(1, -(-stored_bytes(spark, origin) // TARGET_FILE_BYTES))
    table = read_table(spark, origin, recursive)
    rows = Observation()
    counted = table.observe(rows, F.count(F.lit(1)).alias("rows"))
    if by:
        merged = counted.hint("rebalance", by)
    else:
        merged = counted.repartition(num_files) if shuffle else counted.coalesce(num_files)
    write_events(merged, destination, fmt, mode="overwrite", by=by)
    return rows.get["rows"]
