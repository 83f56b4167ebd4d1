"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidings.loads import read_snapshot, snapshot


def read_table(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """A Parquet data set; ``recursive`` reads every file below ``path``, whatever its folder.

    A recursive read does not derive partition columns from folder names. A table of one-step loads
    (see ``tidings.loads``) is read as its newest record has it, in either way.
    """
    if held := snapshot(spark, path):
        return read_snapshot(spark, path, held)
    return spark.read.option("recursiveFileLookup", recursive).parquet(path)
