"""Daily market report engine on Spark.

Typical use::

    from daybar import JobConfig, run
    run(spark, JobConfig(source_path=..., target_prefix=..., ledger_path=..., first_date="2021-09-20"))

or, on a DataFrame of ticks::

    from daybar import daily_report
    report = daily_report(ticks, cutoff="2021-09-20")
"""

from daybar.config import JobConfig, ReportColumns, SourceColumns, job_config_from_mapping
from daybar.operators import daily_bars, daily_report
from daybar.plans import plan_days, run
from daybar.sinks import publish
from daybar.sources import read_days

__all__ = [
    "JobConfig", "ReportColumns", "SourceColumns", "daily_bars", "daily_report", "job_config_from_mapping",
    "plan_days", "publish", "read_days", "run",
]
