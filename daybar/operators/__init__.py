"""Relational operators of the daily report."""

from daybar.operators.bars import daily_bars, first_price, last_price, open_per_tick, with_tick_order
from daybar.operators.report import apply_cutoff, daily_report, select_ticks, with_change
from daybar.operators.windows import frame_lag, lag_within

__all__ = [
    "apply_cutoff", "daily_bars", "daily_report", "first_price", "frame_lag", "lag_within",
    "last_price", "open_per_tick", "select_ticks", "with_change", "with_tick_order",
]
