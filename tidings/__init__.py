"""Coded news events on Spark: read, search, enrich, summarize and store."""
