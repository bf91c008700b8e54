"""Which days to read: calendar minus ledger, resumed with a lookback day."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybar.config import NOTHING_TO_DO_CUTOFF
from daybar.functions.dates import as_of_string
from daybar.plans.ledger import check_ledger_days, ledger_days


@dataclass(frozen=True)
class DayPlan:
    cutoff: str            # first day that goes into the report
    days: tuple[str, ...]  # days to read: cutoff minus lookback ... as_of

    @property
    def days_to_record(self) -> list[str]:
        return [d for d in self.days if d >= self.cutoff]


def _d(text: str) -> _dt.date:
    return _dt.date.fromisoformat(text)


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive (``day`` DATE); empty if start > end."""
    s, e = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    if _d(start) > _d(end):  # sequence() would count down
        return spark.createDataFrame([], T.StructType([T.StructField("day", T.DateType())]))
    return spark.range(1).select(F.explode(F.sequence(s, e)).alias("day"))


def _span(start: _dt.date, end: _dt.date) -> tuple[str, ...]:
    n = (end - start).days
    return tuple((start + _dt.timedelta(days=i)).isoformat() for i in range(n + 1)) if n >= 0 else ()


def plan_days(spark: SparkSession, ledger: DataFrame | None, first_date: str, as_of=None,
              lookback_days: int = 1) -> DayPlan:
    """The reference's planner.

    Calendar = first_date - lookback … as_of. Without a ledger every calendar
    day is read and the cutoff is first_date. With one, the first calendar day
    from first_date on that the ledger lacks is the cutoff, and every calendar
    day from cutoff - lookback on is read again, processed or not. No gap means
    nothing to do (sentinel cutoff 2200-01-01).

    The anti-join and min run in Spark; the driver only receives the one date
    and spans the day list (its length is bounded by the calendar).
    """
    today = _d(as_of_string(as_of))
    first = _d(first_date)
    start = first - _dt.timedelta(days=lookback_days)
    if ledger is None:
        return DayPlan(first.isoformat(), _span(start, today))
    check_ledger_days(ledger)
    cal = calendar(spark, start.isoformat(), today.isoformat())
    missing = cal.where(F.col("day") >= F.lit(first)).join(ledger_days(ledger), "day", "left_anti")
    m = missing.agg(F.min("day").alias("m")).first()["m"]
    if m is None:
        return DayPlan(NOTHING_TO_DO_CUTOFF, ())
    return DayPlan(m.isoformat(), _span(m - _dt.timedelta(days=lookback_days), today))


def plan_frame(spark: SparkSession, plan: DayPlan) -> DataFrame:
    """The plan as rows (day, cutoff) for inspection and checks."""
    schema = T.StructType([T.StructField("day", T.StringType()), T.StructField("cutoff", T.StringType())])
    return spark.createDataFrame([(d, plan.cutoff) for d in plan.days], schema)


def day_ranges(ledger: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys..., first, last): the ledger's days folded to ranges without gaps."""
    cols = [F.col(k) for k in keys]
    days = ledger_days(ledger, keys).where("day is not null")
    nth = F.row_number().over(Window.partitionBy(*cols).orderBy("day"))
    return days.withColumn("island", F.date_sub("day", nth)).groupBy(*cols, "island").agg(
        F.min("day").alias("first"), F.max("day").alias("last")).drop("island")


def plan_days_keyed(keys_df: DataFrame, ledger: DataFrame | None, first_date: str, as_of=None,
                    keys: tuple[str, ...] = ("ISIN",), lookback_days: int = 1) -> DataFrame:
    """The same planner per key, as a distributed query.

    Returns (keys..., day, cutoff) for every key that has a gap: its days to
    read from its own cutoff - lookback to as_of. The ledger's days are folded
    to ranges without gaps (islands) per key; the first unprocessed day from
    first_date on is the day after the range that holds first_date, or
    first_date itself. So there are at most as many rows between as the ledger
    has ranges, and days are only spanned for the answer.
    """
    today = _d(as_of_string(as_of))
    first = _d(first_date)
    cols = [F.col(k) for k in keys]
    per_key = keys_df.select(*cols).distinct()
    if ledger is None:
        gaps = per_key.withColumn("m", F.lit(first))
    else:
        held = day_ranges(ledger, keys).where((F.col("first") <= F.lit(first)) & (F.col("last") >= F.lit(first)))
        held = held.select(*cols, F.date_add("last", 1).alias("after"))
        gaps = per_key.join(held, list(keys), "left").withColumn("m", F.coalesce("after", F.lit(first)))
    gaps = gaps.where(F.col("m") <= F.lit(today))
    out = gaps.select(*cols, "m", F.explode(F.sequence(F.date_sub("m", lookback_days), F.lit(today))).alias("day"))
    return out.select(*cols, F.date_format("day", "yyyy-MM-dd").alias("day"),
                      F.date_format("m", "yyyy-MM-dd").alias("cutoff"))
