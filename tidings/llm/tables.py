"""Intermediate tables in the shared folder of the job."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tidings.files import delete
from tidings.shared import new_folder

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Folders made for the innermost :func:`stored_alone` that is under way, if any.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def made_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder of the job, which goes with the other steps of a :func:`stored_alone` under way."""
    path, made = new_folder(spark, purpose), _MADE.get()
    if made is not None:
        made.append(path)
    return path


def stored(df: DataFrame, purpose: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` computed once, written to the shared folder and reread: it survives lost executors.

    ``batch_rows`` bounds the rows that go to a Python worker at once while it is computed, for rows
    with texts: what a batch takes beside the heap of an executor follows from it. The session's own
    setting is put back afterwards.
    """
    conf, path = df.sparkSession.conf, made_folder(df.sparkSession, purpose)
    before = conf.get(_BATCH_ROWS)
    if batch_rows:
        conf.set(_BATCH_ROWS, min(batch_rows, int(before)) if int(before) > 0 else batch_rows)
    try:
        df.write.parquet(path)
    finally:
        conf.set(_BATCH_ROWS, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(make: Callable[[], DataFrame], purpose: str, batch_rows: int | None = None) -> DataFrame:
    """``make()`` stored as by :func:`stored`, without the tables that were stored on the way to it.

    They are removed once the result is written, so a chain of steps holds one step's tables at a time.
    After an error they stay, to be looked at. ``make`` must not hand out frames that read them.
    """
    outer, made = _MADE.get(), []
    token = _MADE.set(made)
    try:
        result = stored(make(), purpose, batch_rows)
    finally:
        _MADE.reset(token)
    for path in made[:-1]:  # the last is the result's own
        delete(result.sparkSession, path)
    if outer is not None:
        outer.append(made[-1])
    return result
