"""Enrichment of raw events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidings.operators import (
    SizedLookup,
    add_actions,
    add_publisher,
    filter_terms,
    one_country_per_domain,
    publisher_lookup,
    select_existing,
    size_lookup,
)
from tidings.schema import KEEP_SHORT, SEARCH_COLUMNS
from tidings.sources import read_action_codes, read_manual_lookup, read_official_lookup


def load_publishers(
    spark: SparkSession, official_path: str, manual_path: str, one_per_domain: bool = False
) -> SizedLookup:
    """The domain lookup of both files, derived, measured and kept once for a whole job."""
    combine = one_country_per_domain if one_per_domain else publisher_lookup
    pairs = combine(read_official_lookup(spark, official_path), read_manual_lookup(spark, manual_path))
    return size_lookup(pairs, keep=True)


def load_actions(spark: SparkSession, path: str, corrections: dict[str, str] | None = None) -> SizedLookup:
    """The action dictionary of a JSON file, measured once for a whole job."""
    return size_lookup(read_action_codes(spark, path, corrections))


def enrich_events(
    events: DataFrame,
    publishers: SizedLookup,
    actions: SizedLookup,
    columns: Sequence[str] = KEEP_SHORT,
    terms: Sequence[str] = (),
    search_columns: Sequence[str] = SEARCH_COLUMNS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Select, search and enrich events, lazily and without a shuffle of the events.

    Terms are searched in the selected columns only. ``carry`` names columns, such as the
    file date, that pass through behind the others.
    """
    kept = select_existing(events, [*columns, *carry])
    if terms:
        kept = filter_terms(kept, terms, [name for name in search_columns if name not in carry])
    enriched = add_actions(add_publisher(kept, publishers), actions)
    order = [name for name in enriched.columns if name not in carry]
    return enriched.select(*order, *[name for name in carry if name in enriched.columns])
