"""Report sinks."""

from daybar.sinks.current import read_current, update_current
from daybar.sinks.publish import check_format, publish, target_name, write_csv, write_parquet

__all__ = ["check_format", "publish", "read_current", "target_name", "update_current", "write_csv", "write_parquet"]
