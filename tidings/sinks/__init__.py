"""Sinks: DataFrames to stored tables."""

from tidings.loads import commit_load, compact_changed, derive_changed, load_dates, write_load
from tidings.sinks.tables import append_table, compact_table, drop_dates, load_table, write_events

__all__ = [
    "append_table",
    "commit_load",
    "compact_changed",
    "compact_table",
    "derive_changed",
    "drop_dates",
    "load_dates",
    "load_table",
    "write_events",
    "write_load",
]
