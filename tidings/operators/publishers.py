"""Publisher domain and country of each event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions import country_from_tld, domain_of
from tidings.operators.lookups import SizedLookup, left_lookup

UNKNOWN_COUNTRY = "Unknown"


def publisher_lookup(official: DataFrame, manual: DataFrame) -> DataFrame:
    """Distinct (domain, country_name) pairs of both lookups.

    A domain listed with two countries keeps both rows.
    """
    pair = ["domain", "country_name"]
    return official.select(*pair).unionByName(manual.select(*pair)).distinct()


def one_country_per_domain(official: DataFrame, manual: DataFrame) -> DataFrame:
    """One country per domain: the manual list wins, then the alphabetically first name."""
    ranked = official.select("domain", "country_name", F.lit(1).alias("rank")).unionByName(
        manual.select("domain", "country_name", F.lit(0).alias("rank"))
    )
    first = F.min(F.struct("rank", "country_name"))["country_name"]
    named = ranked.filter(F.col("country_name").isNotNull())
    return named.groupBy("domain").agg(first.alias("country_name"))


def add_publisher(df: DataFrame, lookup: SizedLookup) -> DataFrame:
    """Append ``domain_name`` and ``news_source_country`` derived from ``SOURCEURL``.

    The country is the lookup's, else the one suggested by the top-level domain, else
    'Unknown'. An event is repeated for each country its domain has in the lookup.
    """
    kept = [name for name in df.columns if name not in ("domain_name", "news_source_country")]
    located = df.select(*kept, domain_of("SOURCEURL").alias("domain_name"))
    countries = lookup.named(_domain="domain", _country="country_name")
    matched = left_lookup(located, countries, F.col("domain_name"), "_domain")
    country = F.coalesce("_country", country_from_tld("domain_name"), F.lit(UNKNOWN_COUNTRY))
    return matched.select(*kept, "domain_name", country.alias("news_source_country"))
