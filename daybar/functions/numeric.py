"""Rounding and percent change with the reference's float semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_dp(c: Column | str, decimals: int = 2) -> Column:
    """Scale, round half to even on the scaled double, scale back.

    This is what a numpy/pandas ``round`` does; Spark's ``round`` rounds half
    up, and ``bround`` works on the decimal value, so neither matches.
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** decimals)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def round_double_columns(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Round every double/float column of ``df``; other columns pass through."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_dp(F.col(f"`{f.name}`"), decimals).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def pct_change(cur: Column | str, prev: Column | str) -> Column:
    """``(cur - prev) / prev * 100`` with IEEE results where prev is zero.

    A zero previous value gives +inf/-inf for a non-zero change and null for
    0/0 (NaN is stored as null, like the reference's Parquet output). A missing
    previous value gives null. Spark's ANSI ``/`` would raise on a zero divisor,
    so the zero case never reaches the division.
    """
    cur = F.col(cur) if isinstance(cur, str) else cur
    prev = F.col(prev) if isinstance(prev, str) else prev
    inf = F.lit(float("inf"))
    return (F.when(prev.isNull() | cur.isNull(), F.lit(None).cast("double"))
            .when(prev == 0, F.when(cur > 0, inf).when(cur < 0, -inf)
                  .otherwise(F.lit(None).cast("double")))
            .otherwise((cur - prev) / prev * F.lit(100.0)))
