"""Landed file manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidings.operators.manifest import parse_manifest


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Daily files listed in a landed manifest of ``size name`` lines."""
    return parse_manifest(spark.read.text(path))
