"""Left lookups whose join strategy follows from the measured size of the lookup.

A lookup is measured once per job. Within the bound it is broadcast, so the (huge) other side is
never shuffled. Beyond it both sides are shuffled once, on the key, and Spark divides the
partitions of hot keys while the join runs: it cuts them by map output, so exact copies of a row
are spread as well.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidings.shared import settled

BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class SizedLookup:
    """A lookup with its measured size."""

    df: DataFrame
    rows: int
    bytes: int
    max_rows: int = BROADCAST_ROWS
    max_bytes: int = BROADCAST_BYTES

    @property
    def broadcastable(self) -> bool:
        return self.rows <= self.max_rows and self.bytes <= self.max_bytes

    def named(self, **columns: str) -> SizedLookup:
        """Only the given columns, under new names: ``named(new="old")``."""
        return replace(self, df=self.df.select(*[F.col(old).alias(new) for new, old in columns.items()]))


def size_lookup(
    df: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    keep: bool = False,
) -> SizedLookup:
    """Measure ``df`` against a broadcast bound with one job.

    ``keep`` is for a lookup that is derived from much data: the job also checkpoints its
    rows, so that they are not derived again for each join. A measurement taken on the way
    may count the rows of a repeated task twice, which only errs towards the shuffled join.
    """
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    measures = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")]
    if keep:
        seen = Observation()
        df = settled(df.observe(seen, *measures))
        size = seen.get
    else:
        size = df.agg(*measures).first()
    return SizedLookup(df, size["rows"], size["bytes"], max_rows, max_bytes)


def left_lookup(df: DataFrame, lookup: SizedLookup, key: Column, lookup_key: str, null_safe: bool = False) -> DataFrame:
    """``df`` left-joined with ``lookup`` on ``key = lookup_key``; the lookup key is dropped.

    A key with several lookup rows multiplies the rows of ``df``; a key without any keeps
    them once with NULLs. ``null_safe`` lets a NULL key meet a NULL lookup key. Lazy: no job runs.
    """
    right = lookup.df.withColumnRenamed(lookup_key, "_lookup_key")
    same_key = key.eqNullSafe(F.col("_lookup_key")) if null_safe else key == F.col("_lookup_key")
    joined = F.broadcast(right) if lookup.broadcastable else right.hint("merge")
    return df.join(joined, same_key, "left").drop("_lookup_key")
