"""Term search over several columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_columns(columns: Sequence[Column | str], terms: Sequence[str]) -> Column:
    """The columns as one text, joined by a character that no term contains; NULL counts as the empty string."""
    separator = next(mark for mark in map(chr, range(1, 0x10000)) if not any(mark in term for term in terms))
    return F.concat_ws(separator, *columns)


def contains_any(columns: Sequence[Column | str], terms: Sequence[str]) -> Column:
    """True where any column holds any term as a substring, ignoring case.

    NULL counts as the empty string, wildcards are literal, and the empty term matches
    every row. Both sequences must be non-empty.

    The columns are joined by a character that no term contains and searched once for all
    terms, so the cost grows little with the number of terms and each column is read once.
    """
    if not columns or not terms:
        raise ValueError("contains_any needs at least one column and one term")
    wanted = sorted({term.lower() for term in terms})
    if "" in wanted:
        return F.lit(True)
    first_characters = "".join(sorted({re.escape(term[0]) for term in wanted}))
    pattern = f"(?=[{first_characters}])(?:{'|'.join(map(re.escape, wanted))})"
    return F.rlike(F.lower(joined_columns(columns, wanted)), F.lit(pattern))
