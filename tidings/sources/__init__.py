"""Sources: files to DataFrames."""

from tidings.sources.archives import archive_events, archive_status, expand_archives, whole_lines
from tidings.sources.events import count_rejects, read_events, read_events_latin1
from tidings.sources.fetch import fetch_files, http_get
from tidings.sources.lookups import (
    parse_action_codes,
    read_action_codes,
    read_manual_lookup,
    read_official_lookup,
)
from tidings.sources.manifest import read_manifest
from tidings.sources.tables import read_table

__all__ = [
    "archive_events",
    "archive_status",
    "count_rejects",
    "expand_archives",
    "fetch_files",
    "http_get",
    "parse_action_codes",
    "read_action_codes",
    "read_events",
    "read_events_latin1",
    "read_manifest",
    "read_manual_lookup",
    "read_official_lookup",
    "read_table",
    "whole_lines",
]
