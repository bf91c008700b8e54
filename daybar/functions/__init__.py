"""Scalar column functions (all built from pyspark.sql.functions, JVM-side)."""

from daybar.functions.dates import (
    add_days, day_diff, first_path_segment, format_date, format_stamp, parse_date, today,
)
from daybar.functions.nulls import NA_TOKENS, na_tokens_to_null
from daybar.functions.numeric import pct_change, round_dp, round_double_columns

__all__ = [
    "NA_TOKENS", "add_days", "day_diff", "first_path_segment", "format_date", "format_stamp",
    "na_tokens_to_null", "parse_date", "pct_change", "round_dp", "round_double_columns", "today",
]
