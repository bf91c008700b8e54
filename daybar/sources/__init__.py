"""Sources: object listing, CSV scans, day-keyed trees, driver-table adapters."""

from daybar.sources.adapters import events_hourly_ticks, events_ticks, lineitem_ticks, load_ticks
from daybar.sources.csv import cast_ticks, empty_ticks, header_census, read_csv, read_csv_by_name, tick_schema, union_by_name
from daybar.sources.days import day_glob, read_days, read_since, write_day_tree
from daybar.sources.listing import list_objects

__all__ = [
    "cast_ticks", "day_glob", "empty_ticks", "events_hourly_ticks", "events_ticks", "lineitem_ticks",
    "header_census", "list_objects", "load_ticks", "read_csv", "read_csv_by_name", "read_days", "read_since", "tick_schema",
    "union_by_name", "write_day_tree",
]
