"""Numbers of rows within a key, for keys of any number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.tables import stored


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: their number, from 1, among those of equal ``keys``, by ``order`` (nulls first).

    Rows are numbered within ranges of (keys, order), and moved on by the counts of the ranges before, so
    that a key with any number of rows is spread. Rows equal in keys and order, which may be very many as
    well, are told apart by their place in the input.
    """
    by = [F.col(c).asc_nulls_first() for c in [*order, "met"]]
    met = rows.withColumn("met", F.monotonically_increasing_id())
    dealt = met.repartitionByRange(*[F.col(c).asc_nulls_first() for c in keys], *by).withColumn("range", F.spark_partition_id())
    dealt = stored(dealt, "ranges")
    inside = F.row_number().over(Window.partitionBy("range", *keys).orderBy(*by))
    earlier = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy(*keys, "range").agg(F.count(F.lit(1)).alias("n"))
    before = before.select(
        *[F.col(k).alias(f"{k}_before") for k in keys], F.col("range").alias("own"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    ).where("before > 0")
    same = F.col("range") == F.col("own")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{k}_before"))
    placed = dealt.withColumn("inside", inside).join(before, same, "left")
    return placed.select(*rows.columns, (F.col("inside") + F.coalesce("before", F.lit(0))).alias(name))
