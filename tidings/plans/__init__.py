"""Jobs composed of sources, operators and sinks."""

from tidings.plans.enrich import enrich_events, load_actions, load_publishers
from tidings.plans.ingest import Loaded, fetch_range, ingest_archives, ingest_files, run_ingest
from tidings.plans.summaries import update_article_states

__all__ = [
    "Loaded",
    "enrich_events",
    "fetch_range",
    "ingest_archives",
    "ingest_files",
    "load_actions",
    "load_publishers",
    "run_ingest",
    "update_article_states",
]
