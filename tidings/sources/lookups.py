"""Domain lookups and the action dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_official_lookup(spark: SparkSession, path: str) -> DataFrame:
    """``domain, country_name`` of a headerless TSV with a country code between them."""
    columns = "domain string, country_code string, country_name string"
    return spark.read.schema(columns).option("sep", "\t").csv(path).select("domain", "country_name")


def read_manual_lookup(spark: SparkSession, path: str) -> DataFrame:
    """``domain, country_name`` of a CSV with that header."""
    return spark.read.schema("domain string, country_name string").option("header", True).csv(path)


def parse_action_codes(
    documents: DataFrame, order: Column | str, corrections: dict[str, str] | None = None
) -> DataFrame:
    """``code, description`` rows of flat JSON objects in column ``value``.

    A code listed twice takes its last description: the later entry of one document, the
    document with the greatest ``order`` otherwise. ``corrections`` override or add codes.
    A document that is no JSON object fails the job.
    """
    entries = documents.select(
        F.struct(order).alias("rank"),
        F.posexplode(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})).alias(
            "position", "code", "description"
        ),
    )
    last = F.max_by("description", F.struct("rank", "position"))
    codes = entries.groupBy("code").agg(last.alias("description"))
    if not corrections:
        return codes
    patch = codes.sparkSession.createDataFrame(list(corrections.items()), "code string, description string")
    return codes.filter(~F.col("code").isin(list(corrections))).unionByName(patch)


def read_action_codes(
    spark: SparkSession, path: str, corrections: dict[str, str] | None = None
) -> DataFrame:
    """The action dictionary of a JSON file that maps codes to descriptions."""
    documents = spark.read.text(path, wholetext=True).select("value", "_metadata.file_path")
    return parse_action_codes(documents, "file_path", corrections)
