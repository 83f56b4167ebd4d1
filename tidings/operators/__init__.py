"""Operators: DataFrame in, DataFrame out."""

from tidings.operators.actions import add_actions
from tidings.operators.articles import (
    article_lists,
    article_parts,
    article_states,
    articles_in_one_row,
    merge_articles,
    summarize_articles,
)
from tidings.operators.chunks import plan_chunks
from tidings.operators.columns import select_existing
from tidings.operators.lookups import SizedLookup, left_lookup, size_lookup
from tidings.operators.manifest import download_plan, in_date_range, parse_manifest, range_size, total_size
from tidings.operators.publishers import add_publisher, one_country_per_domain, publisher_lookup
from tidings.operators.status import status_counts
from tidings.operators.terms import filter_many_terms, filter_terms

__all__ = [
    "SizedLookup",
    "add_actions",
    "add_publisher",
    "article_lists",
    "article_parts",
    "article_states",
    "articles_in_one_row",
    "download_plan",
    "filter_many_terms",
    "filter_terms",
    "in_date_range",
    "left_lookup",
    "merge_articles",
    "one_country_per_domain",
    "parse_manifest",
    "plan_chunks",
    "publisher_lookup",
    "range_size",
    "select_existing",
    "size_lookup",
    "status_counts",
    "summarize_articles",
    "total_size",
]
