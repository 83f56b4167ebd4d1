"""Article summaries that follow a loaded table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from tidings.loads import FILE_DATE, derive_changed
from tidings.operators.articles import article_states


def update_article_states(spark: SparkSession, events: str, states: str) -> list[dt.date]:
    """Bring ``states``, the article states of the loaded table ``events`` by file_date, up to date; returns the dates made anew.

    Only dates with another load since are read. ``merge_articles(read_table(spark, states))`` is the
    summary of the whole table.
    """
    return derive_changed(spark, events, states, lambda rows: article_states(rows, FILE_DATE))
