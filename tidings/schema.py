"""Column lists and schemas of coded news-event data.

Event columns are strings throughout: codes carry significant leading zeros
("010" and "10" are different actions), so nothing is inferred or cast on read.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Parts of the published daily-update layout: 5 + 2 * 10 + 10 + 3 * 7 + 2 = 58 columns.
_IDENTITY = ["GLOBALEVENTID", "SQLDATE", "MonthYear", "Year", "FractionDate"]
_ACTOR = [
    "Code", "Name", "CountryCode", "KnownGroupCode", "EthnicCode",
    "Religion1Code", "Religion2Code", "Type1Code", "Type2Code", "Type3Code",
]
_ACTION = [
    "IsRootEvent", "EventCode", "EventBaseCode", "EventRootCode", "QuadClass",
    "GoldsteinScale", "NumMentions", "NumSources", "NumArticles", "AvgTone",
]
_PLACE = ["Type", "FullName", "CountryCode", "ADM1Code", "Lat", "Long", "FeatureID"]

RAW_COLUMNS: list[str] = (
    _IDENTITY
    + [f"{actor}{part}" for actor in ("Actor1", "Actor2") for part in _ACTOR]
    + _ACTION
    + [f"{geo}_{part}" for geo in ("Actor1Geo", "Actor2Geo", "ActionGeo") for part in _PLACE]
    + ["DATEADDED", "SOURCEURL"]
)

# The two column selections, in output order.
KEEP_SHORT: list[str] = [
    "GLOBALEVENTID",
    "SQLDATE",
    "Actor1Name",
    "Actor1Geo_FullName",
    "Actor2Name",
    "Actor2Geo_FullName",
    "IsRootEvent",
    "EventCode",
    "EventBaseCode",
    "QuadClass",
    "GoldsteinScale",
    "NumMentions",
    "NumSources",
    "NumArticles",
    "AvgTone",
    "ActionGeo_Type",
    "ActionGeo_FullName",
    "ActionGeo_CountryCode",
    "SOURCEURL",
]
KEEP_LARGE: list[str] = [
    "GLOBALEVENTID",
    "SQLDATE",
    "Actor1Code",
    "Actor1Name",
    "Actor1CountryCode",
    "Actor1Geo_CountryCode",
    "Actor1Geo_FullName",
    "Actor1KnownGroupCode",
    "Actor2Code",
    "Actor2Name",
    "Actor2CountryCode",
    "Actor2KnownGroupCode",
    "Actor2Geo_CountryCode",
    "Actor2Geo_FullName",
    "IsRootEvent",
    "EventCode",
    "EventBaseCode",
    "EventRootCode",
    "QuadClass",
    "GoldsteinScale",
    "NumMentions",
    "NumSources",
    "NumArticles",
    "AvgTone",
    "ActionGeo_Type",
    "ActionGeo_FullName",
    "ActionGeo_CountryCode",
    "DATEADDED",
    "SOURCEURL",
]

# The columns searched by the term filter unless the caller names others.
SEARCH_COLUMNS: list[str] = [
    "Actor1Name",
    "Actor1Geo_FullName",
    "Actor2Name",
    "Actor2Geo_FullName",
    "ActionGeo_FullName",
    "ActionGeo_CountryCode",
    "SOURCEURL",
]

ENRICHMENT_COLUMNS: list[str] = ["domain_name", "news_source_country", "Cameo", "Cameo_full"]


def strings(columns: list[str]) -> StructType:
    """A schema in which every column is a nullable string."""
    return StructType([StructField(name, StringType(), True) for name in columns])


RAW_SCHEMA: StructType = strings(RAW_COLUMNS)
