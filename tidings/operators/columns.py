"""Lenient projection."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the requested columns that exist, in the requested order.

    Unknown names are skipped with a warning. When none exists the result is empty and
    keeps the schema of ``df``.
    """
    present = set(df.columns)
    kept = [name for name in columns if name in present]
    skipped = [name for name in columns if name not in present]
    if skipped:
        log.warning("columns not found and skipped: %s", skipped)
    return df.select(*kept) if kept else df.limit(0)
