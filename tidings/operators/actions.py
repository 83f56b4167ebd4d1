"""Action descriptions of each event."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions import root_code
from tidings.operators.lookups import SizedLookup, left_lookup

log = logging.getLogger(__name__)


def add_actions(df: DataFrame, dictionary: SizedLookup) -> DataFrame:
    """Append ``Cameo`` (description of the root code) and ``Cameo_full`` (of the whole code).

    ``dictionary`` has one row per ``code`` with its ``description``. Codes that are NULL or
    not listed give NULL. Without an ``EventCode`` column ``df`` is returned unchanged.
    """
    if "EventCode" not in df.columns:
        log.warning("no EventCode column: action descriptions not added")
        return df
    kept = [name for name in df.columns if name not in ("Cameo", "Cameo_full")]
    described = df.select(*kept)
    for key, name in ((root_code("EventCode"), "Cameo"), (F.col("EventCode"), "Cameo_full")):
        named = dictionary.named(**{"_code": "code", name: "description"})
        described = left_lookup(described, named, key, "_code")
    return described.select(*kept, "Cameo", "Cameo_full")
