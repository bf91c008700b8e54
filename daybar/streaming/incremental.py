"""The daily report job on a Structured Streaming trigger.

Instead of the ledger, Spark's file-source checkpoint remembers which files
were processed. Each micro-batch recomputes the report for the days its new
files touch and for the days after them whose change may look back at those
(reading all these days in full, with their lookback days, from the day-keyed
tree) and publishes it under the batch id, so a retried batch rewrites
nothing. Change never reaches across days that were not read: it is null
there, as on a first day. A late file for an already reported day therefore
causes a new report for that day; the ledger job would not re-read it.
:func:`published_reports` takes each instrument's day from the newest batch.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybar.config import JobConfig
from daybar.operators.report import daily_report
from daybar.operators.windows import lag_within
from daybar.session import apply_required_conf, path_exists, scratch_path
from daybar.sinks.publish import check_format, publish
from daybar.sources.csv import read_csv
from daybar.sources.days import read_days
from daybar.sources.listing import qualified_path

log = logging.getLogger(__name__)


def _plan_batch(touched: list[str], first_date: str, lookback: int) -> tuple[list[str], list[str], list[str]]:
    """Days to report, days to read, and the first day of each unbroken run of days read.

    One entry per calendar day near a touched one, never one per row or file.
    """
    shift = lambda d, n: (_dt.date.fromisoformat(d) + _dt.timedelta(days=n)).isoformat()
    report = sorted({t for d in touched for n in range(lookback + 1) if (t := shift(d, n)) >= first_date})
    read = sorted({shift(d, -n) for d in report for n in range(lookback + 1)})
    known = set(read)
    return report, read, [d for d in read if shift(d, -1) not in known]


def report_batch(spark: SparkSession, cfg: JobConfig, days: list[str], batch_id: int) -> str | None:
    """Report for ``days`` and those that look back at them, published as batch ``batch_id``."""
    days, read, runs = _plan_batch(days, cfg.first_date, cfg.lookback_days)
    if not days:
        return None
    ticks = read_days(spark, cfg.source_path, read, cfg.source, layout=cfg.source_layout,
                      fmt=cfg.source_format, sep=cfg.csv_sep, encoding=cfg.csv_encoding, drop_missing=True)
    rep = daily_report(ticks, cfg.source, cfg.report, None, cfg.change_on, drop_missing=False)
    if len(runs) > 1:  # a previous row of an earlier run is not the previous trading day: days between were not read
        run_of = lambda c: F.size(F.filter(F.lit(runs), lambda start: start <= c))
        rep = lag_within(rep, cfg.source.date, [cfg.source.isin], cfg.source.date, "__prev_day")
        same = run_of(F.col("__prev_day")) == run_of(F.col(f"`{cfg.source.date}`"))
        rep = rep.withColumn(cfg.report.change_prev, F.when(same, F.col(f"`{cfg.report.change_prev}`"))).drop("__prev_day")
    rep = rep.where(F.col(f"`{cfg.source.date}`").isin(days))
    if cfg.sorted_output:
        rep = rep.orderBy(F.col(f"`{cfg.source.isin}`"), F.col(f"`{cfg.source.date}`"))
    target = f"{cfg.target_prefix}batch_{batch_id:010d}.{cfg.target_format}"
    if path_exists(spark, target):  # the batch was published before a restart
        return target
    return publish(rep, target, cfg.target_format)


def _day_of_path(spark: SparkSession, cfg: JobConfig, path: Column) -> Column:
    """The calendar day that a file of the tree is keyed by (ISO text), null for other names."""
    depth = qualified_path(spark, cfg.source_path).count("/") + 1
    inside = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    entry = F.split(inside, "/").getItem(depth)
    if cfg.source_layout == "hive":
        entry = F.when(entry.startswith(f"{cfg.source.date}="), F.substring_index(entry, "=", -1))
    text = F.substring(entry, 1, 10)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull(), text)


def start_report_stream(spark: SparkSession, cfg: JobConfig, checkpoint: str | None = None, *,
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    The stream itself carries only the paths of new files; the days they are
    keyed by, checked to be calendar days, are collected (files under other
    names are passed over) and the report is a batch query over those days. Pass the same
    ``checkpoint`` (a shared folder) on every start to resume where the last
    run stopped; without one, a fresh folder is used and the whole tree is new.
    """
    check_format(cfg.target_format)
    if cfg.source_format not in ("csv", "parquet") or cfg.source_layout not in ("prefix", "hive"):
        raise ValueError("the stream reads day-keyed CSV or Parquet trees (prefix or hive layout)")
    apply_required_conf(spark)
    # Only paths are asked of the binary file source, so no file is opened here; the report reads each once.
    reader = (spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
              .schema("path string, modificationTime timestamp, length long, content binary"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    days = reader.load(cfg.source_path).select(_day_of_path(spark, cfg, F.col("path")).alias("day"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        touched = [r["day"] for r in batch.where(F.col("day").isNotNull()).distinct().collect()]
        out = report_batch(batch.sparkSession, cfg, touched, batch_id)
        log.info("batch %d: %d day(s), published %s", batch_id, len(touched), out)

    w = (days.writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-checkpoint")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def published_reports(spark: SparkSession, cfg: JobConfig) -> DataFrame | None:
    """What the stream published so far: of each instrument's day the row of the newest batch."""
    parent, _, leaf = cfg.target_prefix.rpartition("/")
    pattern = f"{parent}/{leaf}batch_*.{cfg.target_format}"
    try:
        rows = read_csv(spark, pattern, na_tokens=False) if cfg.target_format == "csv" else spark.read.parquet(pattern)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    if rows is None:
        return None
    newest = Window.partitionBy(F.col(f"`{cfg.source.isin}`"), F.col(f"`{cfg.source.date}`")).orderBy(F.col("__batch").desc())
    return (rows.withColumn("__batch", F.regexp_extract(F.col("_metadata.file_path"), r"batch_(\d+)\.[a-z]+/[^/]*$", 1))
            .withColumn("__nth", F.row_number().over(newest)).where("__nth = 1").drop("__batch", "__nth"))
