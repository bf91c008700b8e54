"""The daily report job: plan → extract → transform → load → record."""

from __future__ import annotations

import datetime as _dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybar.config import JobConfig
from daybar.functions.dates import as_of_string
from daybar.operators.report import daily_report
from daybar.plans.backfill import DayPlan, plan_days
from daybar.plans.intents import close_intent, open_intent, plan_intent, recover_intent, take_intent
from daybar.plans.ledger import append_ledger, check_ledger_layout, read_ledger
from daybar.session import apply_required_conf, path_exists
from daybar.sinks.current import update_current
from daybar.sinks.publish import check_format, publish, target_name
from daybar.sources.csv import empty_ticks
from daybar.sources.days import read_days

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunResult:
    plan: DayPlan
    target: str | None          # published report, None when it was empty
    recorded: tuple[str, ...]   # days appended to the ledger


def build_report(spark: SparkSession, cfg: JobConfig, plan: DayPlan):
    """The lazy report plan for a day plan (nothing runs yet)."""
    ticks = read_days(spark, cfg.source_path, list(plan.days), cfg.source, layout=cfg.source_layout,
                      fmt=cfg.source_format, sep=cfg.csv_sep, encoding=cfg.csv_encoding, drop_missing=True)
    rep = daily_report(ticks, cfg.source, cfg.report, plan.cutoff, cfg.change_on, drop_missing=False)
    if cfg.sorted_output:
        rep = rep.orderBy(F.col(f"`{cfg.source.isin}`"), F.col(f"`{cfg.source.date}`"))
    return rep


def run(spark: SparkSession, cfg: JobConfig, as_of=None, now: _dt.datetime | None = None,
        recover: bool = False) -> RunResult:
    """One scheduled run.

    The report is published before the ledger is appended, and the planned days
    are recorded even when they had no files (the reference's behaviour). The
    ledger's run intent is taken before the ledger is read and closed after the
    append: a second run at the same time, or one after a run that died in
    between, raises ``RunIntentError`` instead of publishing the days again.
    ``recover`` first ends the dead run (``plans.intents.recover_intent``). A run
    that fails before its report is in place gives its intent back.
    """
    check_format(cfg.target_format)
    apply_required_conf(spark)
    as_of = as_of_string(as_of)
    check_ledger_layout(spark, cfg.ledger_path)  # before anything is published
    if recover:
        dead = open_intent(spark, cfg.ledger_path)
        if dead and dead.target and path_exists(spark, dead.target) and cfg.current_path:
            update_current(_published(spark, cfg, dead.target), cfg.current_path, cfg.source.date)
        log.info("open run: %s", recover_intent(spark, cfg.ledger_path))
    intent = take_intent(spark, cfg.ledger_path, as_of)
    target = None
    try:
        ledger = read_ledger(spark, cfg.ledger_path)  # column check happens here, once
        plan = plan_days(spark, ledger, cfg.first_date, as_of, cfg.lookback_days)
        log.info("cutoff %s, %d day(s) to read", plan.cutoff, len(plan.days))
        if not plan.days:
            close_intent(spark, cfg.ledger_path)
            return RunResult(plan, None, ())
        recorded = plan.days_to_record
        name = target_name(cfg.target_prefix, cfg.target_format, now, _py_format(cfg.target_time_format))
        plan_intent(spark, cfg.ledger_path, intent, plan.cutoff, recorded, name)
        target = publish(build_report(spark, cfg, plan), name, cfg.target_format)
    except Exception:
        close_intent(spark, cfg.ledger_path)  # nothing of this run is visible: publish renames last
        raise
    if target and cfg.current_path:
        update_current(_published(spark, cfg, target), cfg.current_path, cfg.source.date)
    append_ledger(spark, cfg.ledger_path, recorded, as_of, checked=ledger is not None)
    close_intent(spark, cfg.ledger_path)
    return RunResult(plan, target, tuple(recorded))


def _published(spark: SparkSession, cfg: JobConfig, target: str) -> DataFrame:
    """A published report with the types of the report, so that the current table is not computed a second time."""
    if cfg.target_format == "parquet":
        return spark.read.parquet(target)
    empty = daily_report(empty_ticks(spark, cfg.source), cfg.source, cfg.report, None, cfg.change_on, drop_missing=False)
    return spark.read.schema(empty.schema).option("header", True).option("escape", '"').csv(target)


def _py_format(spark_pattern: str) -> str:
    """Translate the few datetime pattern letters used in target names."""
    out = spark_pattern
    for a, b in (("yyyy", "%Y"), ("MM", "%m"), ("dd", "%d"), ("HH", "%H"), ("mm", "%M"), ("ss", "%S")):
        out = out.replace(a, b)
    return out
