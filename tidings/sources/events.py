"""Tab-separated event files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tidings.functions import file_date
from tidings.schema import RAW_COLUMNS, strings

# Tab-separated, no header and no quoting: a field may start with a quotation mark.
TSV_OPTIONS = {"sep": "\t", "header": "false", "quote": ""}


def _tsv(spark: SparkSession, headers: Sequence[str], encoding: str) -> DataFrameReader:
    return spark.read.schema(strings(list(headers))).options(**TSV_OPTIONS).option("encoding", encoding)


def read_events(
    spark: SparkSession,
    path: str | list[str],
    headers: Sequence[str] = RAW_COLUMNS,
    encoding: str = "UTF-8",
    file_date_column: str | None = None,
    rejected_column: str | None = None,
    pattern: str = "*.[cC][sS][vV]",
) -> DataFrame:
    """Event files (``*.csv`` in any case, or of another ``pattern``) directly below ``path``, every column a string.

    Columns are named by position. Empty fields are NULL, and so are the columns that a
    shorter line lacks. A folder that is missing or has no such file gives an empty result
    with the same schema. ``file_date_column`` names a column for the date in the file name.

    Fields beyond the columns are cut off. ``rejected_column`` names a column that holds the whole line
    where it has too many or too few fields, and is NULL elsewhere; it is found in the same pass (see
    :func:`count_rejects`).
    """
    wanted = [*headers, *([rejected_column] if rejected_column else [])]
    reader = _tsv(spark, wanted, encoding).option("pathGlobFilter", pattern)
    if rejected_column:
        # Fields of a line can only be counted where all of them are parsed.
        reader = reader.option("columnNameOfCorruptRecord", rejected_column).option("columnPruning", False)
    try:
        events = reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        events = spark.createDataFrame([], strings(wanted))
        return events.withColumn(file_date_column, F.lit(None).cast("date")) if file_date_column else events
    if file_date_column:
        events = events.select("*", file_date("_metadata.file_name").alias(file_date_column))
    return events


def count_rejects(events: DataFrame, rejected_column: str, n_fields: int = len(RAW_COLUMNS)) -> DataFrame:
    """Of events read with a ``rejected_column``, per file: its lines, and those with too few and too many fields."""
    fields = F.size(F.split(rejected_column, "\t", -1))
    # Spark does not read the column of rejects alone, so lines are counted by another one.
    other = F.col(next(c for c in events.columns if c != rejected_column))
    return events.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        (F.count(other) + F.count_if(other.isNull())).alias("lines"),
        F.count_if(fields < n_fields).alias("too_short"),
        F.count_if(fields > n_fields).alias("too_long"),
    )


def read_events_latin1(
    spark: SparkSession, path: str | list[str], headers: Sequence[str] = RAW_COLUMNS
) -> DataFrame:
    """Latin-1 event files at ``path``, a file or a folder, whatever their extension."""
    return _tsv(spark, headers, "ISO-8859-1").csv(path)
