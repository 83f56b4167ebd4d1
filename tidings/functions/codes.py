"""Action-code helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def root_code(code: Column | str) -> Column:
    """First two digits of an action code; '' when it does not start with two digits."""
    return F.regexp_extract(code, r"^\d{2}", 0)
