"""Date parsing, formatting and arithmetic on columns."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, fmt: str = DAY_FORMAT) -> Column:
    """String to DATE; ANSI mode raises on text that is not a date."""
    return F.to_date(_c(c), fmt)


def format_date(c: Column | str, fmt: str = DAY_FORMAT) -> Column:
    return F.date_format(_c(c), fmt)


def format_stamp(c: Column | str, fmt: str = "yyyyMMdd_HHmmss") -> Column:
    return F.date_format(_c(c), fmt)


def add_days(c: Column | str, n: int | Column) -> Column:
    return F.date_add(_c(c), n)


def day_diff(end: Column | str, start: Column | str) -> Column:
    return F.datediff(_c(end), _c(start))


def first_path_segment(c: Column | str) -> Column:
    """Text before the first '/', e.g. the day prefix of an object key."""
    return F.split(_c(c), "/", 2).getItem(0)


def today(as_of: str | _dt.date | None = None) -> Column:
    """The run date as a DATE literal; ``None`` means the session's current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, _dt.date):
        as_of = as_of.isoformat()
    return F.to_date(F.lit(as_of))


def as_of_string(as_of: str | _dt.date | None = None) -> str:
    """The run date as ``yyyy-MM-dd`` text (driver-side, for paths and logs)."""
    if as_of is None:
        return _dt.date.today().isoformat()
    if isinstance(as_of, _dt.date):
        return as_of.isoformat()
    return _dt.date.fromisoformat(as_of).isoformat()
