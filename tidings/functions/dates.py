"""Dates carried by daily file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_stem(name: Column | str) -> Column:
    """Text before the first dot of a file name."""
    return F.substring_index(F.col(name) if isinstance(name, str) else name, ".", 1)


def file_date(name: Column | str) -> Column:
    """Date of a daily file named ``yyyyMMdd.*``.

    NULL for other names (yearly and monthly archives have shorter stems) and for
    eight digits that are no calendar date.
    """
    stem = file_stem(name)
    # Archives have it evaluated for every line: a cast costs a fraction of parsing by a pattern.
    day = F.concat_ws("-", F.substring(stem, 1, 4), F.substring(stem, 5, 2), F.substring(stem, 7, 2))
    return F.when(F.rlike(stem, F.lit(r"^[0-9]{8}\z")), day.try_cast("date"))
