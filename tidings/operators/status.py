"""Download status histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame


def status_counts(df: DataFrame) -> DataFrame:
    """Number of files per ``download_status``."""
    return df.groupBy("download_status").count()
