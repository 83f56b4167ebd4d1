"""Date windows of a long ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plan_chunks(ranges: DataFrame, days: int = 10) -> DataFrame:
    """Cut each (start_date, end_date) row into windows of ``days`` days, the last one clipped.

    Adds ``chunk``, ``chunk_start`` and ``chunk_end``; a range that ends before it starts,
    or has a NULL bound, has no windows.
    """
    if days < 1:
        raise ValueError("days must be at least 1")
    valid = ranges.filter(F.col("start_date") <= F.col("end_date"))
    step = F.make_dt_interval(days=F.lit(days))
    starts = F.sequence(F.col("start_date"), F.col("end_date"), step)
    windows = valid.select("*", F.posexplode(starts).alias("chunk", "chunk_start"))
    last_day = F.least(F.date_add("chunk_start", days - 1), F.col("end_date"))
    return windows.withColumn("chunk_end", last_day)
