"""The daily report (report1) as one lazy DataFrame plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybar.config import ReportColumns, SourceColumns
from daybar.functions.numeric import pct_change, round_double_columns
from daybar.operators.bars import daily_bars
from daybar.operators.windows import lag_within


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def select_ticks(ticks: DataFrame, src: SourceColumns = SourceColumns()) -> DataFrame:
    """Keep the configured columns and drop any tick with a missing value in them.

    The drop covers every configured column (also ones the report never reads),
    and NaN counts as missing.
    """
    cols = list(src.columns)
    return ticks.select(*[_q(c) for c in cols]).na.drop("any", subset=cols)


def with_change(bars: DataFrame, src: SourceColumns = SourceColumns(),
                rep: ReportColumns = ReportColumns(), on: str = "open") -> DataFrame:
    """Percent change against the previous trading day of the same instrument.

    ``on="open"`` compares opening prices (the reference job); ``on="close"``
    compares closing prices (its prototype). The window runs on day-grain rows,
    so one instrument contributes at most one row per day to its partition.
    """
    if on not in ("open", "close"):
        raise ValueError("on must be 'open' or 'close'")
    value = rep.opening_price if on == "open" else rep.closing_price
    prev = "__prev"
    out = lag_within(bars, value, [src.isin], src.date, prev)
    return out.withColumn(rep.change_prev, pct_change(_q(value), F.col(prev))).drop(prev)


def apply_cutoff(df: DataFrame, date_col: str, cutoff: str | None) -> DataFrame:
    """Rows on or after ``cutoff`` (ISO text compares like dates)."""
    if cutoff is None:
        return df
    return df.where(_q(date_col) >= F.lit(cutoff))


def daily_report(ticks: DataFrame, src: SourceColumns = SourceColumns(),
                 rep: ReportColumns = ReportColumns(), cutoff: str | None = None,
                 change_on: str = "open", drop_missing: bool = True) -> DataFrame:
    """select → drop missing → bars → lag/change → round → cutoff.

    The cutoff filter sits above the window on purpose: the lookback day must
    reach the lag before it is dropped. ``drop_missing=False`` is for ticks a
    source already cleaned (``read_days(drop_missing=True)``): a null filter
    here would be pushed below the source's casts and evaluate them twice.
    """
    t = select_ticks(ticks, src) if drop_missing else ticks.select(*[_q(c) for c in src.columns])
    bars = daily_bars(t, src, rep)
    out = round_double_columns(with_change(bars, src, rep, on=change_on))
    out = apply_cutoff(out, src.date, cutoff)
    return out.select(_q(src.isin), _q(src.date), _q(rep.opening_price), _q(rep.closing_price),
                      _q(rep.minimum_price), _q(rep.maximum_price), _q(rep.daily_traded_volume),
                      _q(rep.change_prev))
