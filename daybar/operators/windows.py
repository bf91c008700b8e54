"""Lag operators: per key, and over a whole ordered frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def lag_within(df: DataFrame, value: str, keys: list[str] | tuple[str, ...], order: str,
               out: str, offset: int = 1) -> DataFrame:
    """Value of the previous available row of the same key (null for the first)."""
    w = Window.partitionBy(*[_q(k) for k in keys]).orderBy(_q(order))
    return df.withColumn(out, F.lag(_q(value), offset).over(w))


def frame_lag(df: DataFrame, order: str, values: list[str], suffix: str = "_prev",
              buckets: int | None = None) -> DataFrame:
    """Shift ``values`` down by one row over the whole frame ordered by ``order``.

    ``order`` must be unique (a day-indexed frame; at most one null, which comes
    first). No task sees the whole frame, and building the plan runs no job:
    one range exchange deals the rows to ``buckets`` ranges, the lag runs inside
    each, and the first row of a range takes the last row of the range before
    from a carry table of one row a range (``buckets`` rows at most, never the
    data size). Both branches read the rows whole, as one struct, so that Spark
    reuses the exchange and scans the input once.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A given number of ranges is never coalesced, so the partition's number is the range's in both branches.
    ranged = df.select(F.struct(*[_q(c) for c in df.columns]).alias("__row")).repartitionByRange(n, F.col("__row").getField(order))
    ranged = ranged.withColumn("__b", F.spark_partition_id())
    key = F.col("__row").getField(order)
    w = Window.partitionBy("__b").orderBy(key)
    inner = ranged.select("__row", "__b", F.lag("__row").over(w).alias("__before"), (F.row_number().over(w) == 1).alias("__first"))
    last = ranged.groupBy("__b").agg(F.max_by("__row", F.struct(key.isNotNull(), key)).alias("__last"))
    carry = last.select("__b", F.lag("__last").over(Window.orderBy("__b")).alias("__carry"))  # one row a range
    out = inner.join(F.broadcast(carry), "__b", "left")
    before = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__before"))
    return out.select(*[F.col("__row").getField(c).alias(c) for c in df.columns],
                      *[before.getField(v).alias(v + suffix) for v in values])
