"""Any-term-in-any-column filter."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions import contains_any
from tidings.functions.terms import joined_columns

log = logging.getLogger(__name__)


def filter_terms(df: DataFrame, terms: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows in which any of ``columns`` holds any of ``terms`` (see ``contains_any``).

    No terms or no columns leave ``df`` unchanged; unknown columns are skipped, and when
    all are unknown the result is empty with the same schema.
    """
    if not terms or not columns:
        return df
    present = set(df.columns)
    searched = [name for name in columns if name in present]
    if not searched:
        log.warning("none of the columns to search exists: %s", list(columns))
        return df.limit(0)
    return df.filter(contains_any(searched, terms))


#: Characters of all terms together that are made into an automaton and broadcast (some 100 bytes each).
MAX_TERM_CHARACTERS = 2_000_000


def filter_many_terms(
    df: DataFrame, terms: Sequence[str], columns: Sequence[str], max_characters: int = MAX_TERM_CHARACTERS
) -> DataFrame:
    """The rows that :func:`filter_terms` gives, for thousands of terms.

    The terms are one automaton, which reads a text once, whatever their number, and stops at the first
    hit; an alternation of a regular expression tries term after term. The automaton is broadcast once;
    terms of more than ``max_characters`` in all are an error. Rows go through Arrow in batches, so
    few terms are better searched by :func:`filter_terms`.
    """
    if not terms or not columns:
        return df
    present = set(df.columns)
    searched = [name for name in columns if name in present]
    wanted = sorted({term.lower() for term in terms})
    if not searched or "" in wanted:
        return filter_terms(df, terms, columns)
    if sum(map(len, wanted)) > max_characters:
        raise ValueError(f"the terms have more than {max_characters} characters")

    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term in wanted:
        automaton.add_word(term, 1)
    automaton.make_automaton()
    sent = df.sparkSession.sparkContext.broadcast(automaton)

    def search(batches: Iterator) -> Iterator:
        # Imports stay inside: workers need not have this package installed.
        import pyarrow as pa

        found = sent.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            hit = pa.array([next(found.iter(text), None) is not None for text in texts], pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1]).filter(hit)

    text = F.lower(joined_columns(searched, wanted)).alias("_".join([*df.columns, "searched"]))
    return df.select(*[F.col(f"`{c}`") for c in df.columns], text).mapInArrow(search, df.schema)
