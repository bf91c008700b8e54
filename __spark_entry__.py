"""

Every query reads the driver's Parquet tables in full, or files Spark writes
from them (CSV day trees, ledgers, published reports) under the session's
shared ``spark.checkpoint.dir``. The tick adapters map the tables onto the
report's tick schema (events: one instrument per user; lineitem: one per
supplier; events_hourly: one per event type, with ties on time).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybar.config import JobConfig, SourceColumns, job_config_from_mapping
from daybar.functions import dates as D
from daybar.functions.numeric import round_double_columns, round_dp
from daybar.operators import (
    apply_cutoff, daily_bars, daily_report, frame_lag, lag_within, open_per_tick, select_ticks,
)
from daybar.plans import append_ledger, plan_days, plan_days_keyed, plan_frame, read_ledger, run
from daybar.session import apply_required_conf, scratch_path
from daybar.sinks import publish, read_current
from daybar.sources import (
    cast_ticks, list_objects, load_ticks, read_csv, read_days, read_since, union_by_name,
    write_day_tree,
)
from daybar.sources.adapters import LINEITEM_TIME_ORDER, source_columns, table
from daybar.streaming import published_reports, start_report_stream

try:  # the llm operators and their pipeline are optional
    from daybar.llm.queries import QUERIES as _LLM_QUERIES, SQL as _LLM_SQL
except ImportError:
    _LLM_QUERIES, _LLM_SQL = {}, {}
try:
    import corpus_pipeline
    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": corpus_pipeline.run}
except ImportError:
    pass

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed parameters of the registered queries (the oracle SQL uses the same).
CUTOFF = "2024-01-10"
SCAN_DAYS = ("2024-01-05", "2024-01-06", "2024-01-07", "2024-01-12", "2024-01-13", "2024-02-15")
SINCE = "2024-01-20"
LOOKUP_ISIN = "U7"
ORDERS_FIRST, ORDERS_AS_OF, ORDERS_STAMP = "1995-01-01", "2001-08-31", "2001-08-01"
KEYED_FIRST, KEYED_AS_OF = "2024-01-02", "2024-01-30"
JOB_FIRST, JOB_AS_OF, JOB_LOOKBACK = "2024-01-10", "2024-01-31", "2024-01-09"
LEDGER_FIRST_RUN = "2024-01-20"
STREAM_FIRST = "2024-01-02"


def _ticks(spark, sf_dir, kind="events"):
    apply_required_conf(spark)
    return load_ticks(spark, sf_dir, kind)


def _bars(spark, sf_dir, kind, src=None):
    src = src or source_columns(kind)
    return daily_bars(select_ticks(_ticks(spark, sf_dir, kind), src), src)


def _tree(spark, sf_dir, layout="prefix", **csv_opts):
    """The events ticks written as a day-keyed CSV tree; returns its path."""
    base = scratch_path(spark, f"src-{layout}")
    write_day_tree(_ticks(spark, sf_dir), base, layout=layout, **csv_opts)
    return base


# Events carry their time to the microsecond; no two of a user's day share it.
UNIQUE = SourceColumns(time_order="unique_clock")


def q_report1(spark, sf_dir):
    return daily_report(_ticks(spark, sf_dir), UNIQUE, cutoff=CUTOFF)


def q_report1_close_change(spark, sf_dir):
    return daily_report(_ticks(spark, sf_dir), UNIQUE, cutoff=CUTOFF, change_on="close")


def q_report1_lineitem(spark, sf_dir):
    return daily_report(_ticks(spark, sf_dir, "lineitem"), source_columns("lineitem"), cutoff="1996-01-01")


def q_report1_ties(spark, sf_dir):
    return daily_report(_ticks(spark, sf_dir, "events_hourly"), cutoff=CUTOFF)


def q_daily_bars(spark, sf_dir):
    return _bars(spark, sf_dir, "events", UNIQUE)


def q_sink_csv_lines(spark, sf_dir):
    # The published CSV as raw text lines: quotes doubled, the leading blank kept.
    ev = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit(" "), F.col("props")).alias("props"))
    path = publish(ev, scratch_path(spark, "lines") + ".csv", "csv")
    return spark.read.text(path).where(F.col("value") != "event_id,props").select(F.col("value").alias("line"))


def q_scan_csv_multiline(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("page_id"), "html")
    path = publish(pages, scratch_path(spark, "pages") + ".csv", "csv")
    return read_csv(spark, path, multi_line=True, na_tokens=False)


def q_ledger_append_reordered(spark, sf_dir):
    # A ledger whose columns stand the other way round is read, appended to and read again.
    path = scratch_path(spark, "ledger")
    read_ledger(spark, _orders_ledger(spark, sf_dir)).select(
        "datetime_of_processing", "source_file_date").write.option("header", True).csv(path)
    plan = plan_days(spark, read_ledger(spark, path), ORDERS_FIRST, ORDERS_AS_OF)
    append_ledger(spark, path, plan.days_to_record, ORDERS_AS_OF)
    return read_ledger(spark, path)


def q_daily_bars_lineitem(spark, sf_dir):
    return _bars(spark, sf_dir, "lineitem")


def q_daily_bars_ties(spark, sf_dir):
    # Ties on the hour, ordered through the numeric (clock time, price) key.
    return _bars(spark, sf_dir, "events_hourly", SourceColumns(time_order="clock"))


def q_daily_bars_ties_text(spark, sf_dir):
    # The same bars with the time compared as text (the default ordering).
    return _bars(spark, sf_dir, "events_hourly", SourceColumns(time_order="text"))


def q_daily_bars_lineitem_numeric(spark, sf_dir):
    # lineitem's digit-string Time through an expression key.
    return _bars(spark, sf_dir, "lineitem", SourceColumns(time_order=LINEITEM_TIME_ORDER))


def q_open_per_tick(spark, sf_dir):
    return open_per_tick(_ticks(spark, sf_dir))


def q_prev_open(spark, sf_dir):
    bars = _bars(spark, sf_dir, "events")
    return lag_within(bars, "opening_price_eur", ["ISIN"], "Date", "prev_open")


def q_day_lag(spark, sf_dir):
    t = _ticks(spark, sf_dir)
    days = t.groupBy("Date").agg(F.count(F.lit(1)).alias("n_ticks"), F.max("MaxPrice").alias("high"),
                                 F.sum("TradedVolume").alias("volume"))
    return frame_lag(days, "Date", ["n_ticks", "high"])


def q_change_pct_zero_prev(spark, sf_dir):
    # Error events carry no price: their StartPrice is zero.
    t = _ticks(spark, sf_dir).withColumn(
        "StartPrice", F.when(F.col("Mnemonic") == "error", F.lit(0.0)).otherwise(F.col("StartPrice")))
    return daily_report(t, cutoff=CUTOFF)


def q_round2(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = li.select("l_orderkey", "l_linenumber",
                    (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
                    (F.col("l_extendedprice") * F.col("l_tax")).alias("tax"), F.col("l_quantity"))
    return round_double_columns(out).withColumn("net_half_up", F.round(
        F.col("l_quantity") / 8, 2)).withColumn("qty_eighths", round_dp(F.col("l_quantity") / 8))


def q_drop_missing(spark, sf_dir):
    t = _ticks(spark, sf_dir).withColumn("Mnemonic", F.expr("nullif(Mnemonic, 'error')")) \
        .withColumn("EndPrice", F.expr("nullif(EndPrice, 1.0)"))
    return select_ticks(t)


def q_cutoff(spark, sf_dir):
    return apply_cutoff(_bars(spark, sf_dir, "events"), "Date", CUTOFF)


def q_lookup(spark, sf_dir):
    return daily_report(_ticks(spark, sf_dir), cutoff=CUTOFF).where(F.col("ISIN") == LOOKUP_ISIN)


def q_scan_days(spark, sf_dir):
    return read_days(spark, _tree(spark, sf_dir), list(SCAN_DAYS))


def q_scan_days_hive(spark, sf_dir):
    return read_days(spark, _tree(spark, sf_dir, "hive"), list(SCAN_DAYS), layout="hive")


def q_scan_since(spark, sf_dir):
    return read_since(spark, _tree(spark, sf_dir), SINCE)


def q_scan_days_semicolon_latin1(spark, sf_dir):
    # CSV scan options of the reference reader: separator and encoding.
    base = _tree(spark, sf_dir, sep=";", encoding="ISO-8859-1")
    return read_days(spark, base, list(SCAN_DAYS), sep=";", encoding="ISO-8859-1")


def q_list_all_objects(spark, sf_dir):
    # Listing with no prefix: every key; reduced to its day folder and file type.
    keys = list_objects(spark, _tree(spark, sf_dir))
    return keys.where(~F.col("key").startswith("_")).select(D.first_path_segment("key").alias("day"),
                       F.regexp_extract("key", r"\.([a-z]+)$", 1).alias("ext")).distinct()


def q_list_objects(spark, sf_dir):
    keys = list_objects(spark, _tree(spark, sf_dir), "2024-01")
    return keys.select(D.first_path_segment("key").alias("day")).distinct()


def q_list_keys_sizes(spark, sf_dir):
    # Every key of a tree with one text file for each day and type, and its size; part names are Spark's own.
    ev = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type",
                                               F.concat_ws(",", "event_id", "user_id").alias("value"))
    base = scratch_path(spark, "keys")
    ev.repartition("day", "event_type").write.partitionBy("day", "event_type").text(base)
    keys = list_objects(spark, base)
    return keys.select(F.regexp_replace("key", "part-[^/]*", "part").alias("key"), "size")


def q_scan_mixed_headers(spark, sf_dir):
    # Two layouts side by side in every day: columns the other way round and one more, folders <day> and <day>_b.
    ticks = _ticks(spark, sf_dir)
    click = F.col("Mnemonic") == "click"
    base = scratch_path(spark, "src-mixed")
    write_day_tree(ticks.where(click), base)
    other = ticks.where(~click).select(*reversed(ticks.columns), F.concat("Date", F.lit("_b")).alias("Folder"))
    write_day_tree(other, base, SourceColumns(date="Folder"), append=True)
    return read_since(spark, base, STREAM_FIRST[:4])


def q_scan_absent_days(spark, sf_dir):
    # A day without files adds nothing; a scan of none but such days, and the report over it, are empty and typed.
    base = _tree(spark, sf_dir)
    absent = read_days(spark, base, ["1999-01-01", "1999-01-02"])
    if daily_report(absent).limit(1).count() or read_days(spark, base, []).limit(1).count():
        raise AssertionError("days without files must give an empty report")
    return absent.unionAll(read_days(spark, base, ["1999-01-01", SCAN_DAYS[0]]))


def q_union_by_name(spark, sf_dir):
    ev = _ticks(spark, sf_dir)
    li = _ticks(spark, sf_dir, "lineitem").select("ISIN", "Date", "StartPrice", "TradedVolume")
    return union_by_name([ev, li])


def q_sink_parquet(spark, sf_dir):
    path = publish(q_report1_lineitem(spark, sf_dir), scratch_path(spark, "report") + ".parquet", "parquet")
    return spark.read.parquet(path)


def q_sink_csv(spark, sf_dir):
    path = publish(_ticks(spark, sf_dir), scratch_path(spark, "ticks") + ".csv", "csv")
    return cast_ticks(read_csv(spark, path))


def _orders_ledger(spark, sf_dir):
    path = scratch_path(spark, "ledger")
    days = table(spark, sf_dir, "orders").select(
        D.format_date(D.parse_date(F.col("o_orderdate").cast("string"), "yyyy-MM-dd HH:mm:ss")).alias("day")
    ).distinct()
    append_ledger(spark, path, [], ORDERS_STAMP, keys_rows=days)
    return path


def q_plan_days(spark, sf_dir):
    led = read_ledger(spark, _orders_ledger(spark, sf_dir))
    return plan_frame(spark, plan_days(spark, led, ORDERS_FIRST, ORDERS_AS_OF))


def q_plan_days_keyed(spark, sf_dir):
    t = _ticks(spark, sf_dir)
    led = t.select("ISIN", F.col("Date").alias("source_file_date"),
                   F.lit(KEYED_AS_OF).alias("datetime_of_processing"))
    return plan_days_keyed(t, led, KEYED_FIRST, KEYED_AS_OF, keys=("ISIN",))


def q_ledger_append(spark, sf_dir):
    path = _orders_ledger(spark, sf_dir)
    plan = plan_days(spark, read_ledger(spark, path), ORDERS_FIRST, ORDERS_AS_OF)
    append_ledger(spark, path, plan.days_to_record, ORDERS_AS_OF)
    return read_ledger(spark, path)


def q_date_fns(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    day = D.format_date(F.col("o_orderdate"))
    d = D.parse_date(day)
    return o.select(
        F.col("o_orderkey"), day.alias("day"),
        D.format_date(D.add_days(d, 1)).alias("next_day"),
        D.format_date(F.date_sub(d, 1)).alias("prev_day"),
        D.day_diff(F.to_date(F.lit(ORDERS_AS_OF)), d).alias("days_to_as_of"),
        D.format_stamp(F.col("o_orderdate")).alias("stamp"),
        D.first_path_segment(F.concat(day, F.lit("/"), F.col("o_orderpriority"))).alias("key_day"),
        (d >= F.to_date(F.lit("1998-01-01"))).alias("after_1998"),
    )


def q_job_twice(spark, sf_dir):
    base = _tree(spark, sf_dir)
    out = scratch_path(spark, "job")
    cfg = JobConfig(source_path=base, target_prefix=f"{out}/report1/daily_report1_",
                    ledger_path=f"{out}/meta/ledger", first_date=JOB_FIRST)
    first = run(spark, cfg, JOB_AS_OF, now=dt.datetime(2024, 2, 1, 6, 0, 0))
    second = run(spark, cfg, JOB_AS_OF, now=dt.datetime(2024, 2, 1, 6, 0, 1))
    if second.target is not None or second.recorded:
        raise AssertionError("second run of the same day must do nothing")
    return spark.read.parquet(first.target)


def q_job_ledger(spark, sf_dir):
    # The ledger after two runs for two dates: days are recorded once, those without files and the last ones too.
    out = scratch_path(spark, "job-ledger")
    cfg = JobConfig(source_path=_tree(spark, sf_dir), target_prefix=f"{out}/report1/daily_report1_",
                    ledger_path=f"{out}/meta/ledger", first_date=JOB_FIRST)
    run(spark, cfg, LEDGER_FIRST_RUN, now=dt.datetime(2024, 2, 1, 6, 0, 0))
    run(spark, cfg, JOB_AS_OF, now=dt.datetime(2024, 2, 1, 6, 0, 1))
    run(spark, cfg, JOB_AS_OF, now=dt.datetime(2024, 2, 1, 6, 0, 2))
    return read_ledger(spark, cfg.ledger_path)


CURRENT_AGAIN = "2024-01-16"


def q_job_current(spark, sf_dir):
    # Two reports that overlap (a ledger of its own lacks the later days): the current table has each day's newest rows.
    out = scratch_path(spark, "job-current")
    cfg = JobConfig(source_path=_tree(spark, sf_dir), target_prefix=f"{out}/report1/daily_report1_",
                    ledger_path=f"{out}/meta/ledger", first_date=JOB_FIRST, current_path=f"{out}/current")
    run(spark, cfg, LEDGER_FIRST_RUN, now=dt.datetime(2024, 2, 1, 6, 0, 0))
    run(spark, replace(cfg, ledger_path=f"{out}/meta/again", first_date=CURRENT_AGAIN), JOB_AS_OF,
        now=dt.datetime(2024, 2, 1, 6, 0, 1))
    return read_current(spark, cfg.current_path)


# A job as its YAML file says it.
MAPPED_JOB = {
    "source": {"src_first_extract_date": "2023-12-05", "src_columns": list(SourceColumns().columns), "src_col_date": "Date",
               "src_col_isin": "ISIN", "src_col_time": "Time", "src_col_start_price": "StartPrice", "src_col_min_price": "MinPrice",
               "src_col_max_price": "MaxPrice", "src_col_traded_vol": "TradedVolume", "src_time_order": "unique_clock"},
    "target": {"trg_col_op_price": "opening_price_eur", "trg_col_clos_price": "closing_price_eur",
               "trg_col_min_price": "minimum_price_eur", "trg_col_max_price": "maximum_price_eur",
               "trg_col_dail_trade_vol": "daily_traded_volume", "trg_col_ch_prev_clos": "change_prev_closing_%",
               "trg_key": "report1/mapped_", "trg_key_date_format": "%Y%m%d_%H%M%S", "trg_format": "parquet"},
    "meta": {"meta_key": "meta/ledger"},
}
MAPPED_FIRST_RUN = "2023-12-10"


def q_job_mapped(spark, sf_dir):
    # A run before there are files publishes nothing and records its days; an append of nothing adds nothing;
    # the next run publishes under its time's name.
    out = scratch_path(spark, "job-mapped")
    cfg = job_config_from_mapping(MAPPED_JOB, source_root=_tree(spark, sf_dir), target_root=out)
    nothing = run(spark, cfg, MAPPED_FIRST_RUN, now=dt.datetime(2024, 2, 1, 6, 0, 0))
    before = read_ledger(spark, cfg.ledger_path).count()
    append_ledger(spark, cfg.ledger_path, [], MAPPED_FIRST_RUN)
    if nothing.target is not None or before != 6 or read_ledger(spark, cfg.ledger_path).count() != before:
        raise AssertionError("a run without files publishes nothing and records its days once")
    run(spark, cfg, JOB_AS_OF, now=dt.datetime(2024, 2, 1, 6, 0, 1))
    report = spark.read.option("recursiveFileLookup", True).parquet(f"{out}/report1")
    return report.withColumn("target", F.regexp_extract("_metadata.file_path", "/(report1/[^/]*)/", 1))


def q_stream_report(spark, sf_dir):
    # The job on a Structured Streaming trigger (availableNow) over the CSV
    # tree: every day is new, so one batch reports all days from first_date.
    base = _tree(spark, sf_dir)
    out = scratch_path(spark, "stream")
    cfg = JobConfig(source_path=base, target_prefix=f"{out}/report1/daily_report1_",
                    ledger_path=f"{out}/meta/ledger", first_date=STREAM_FIRST)
    start_report_stream(spark, cfg, f"{out}/checkpoint").awaitTermination()
    return published_reports(spark, cfg)


def q_stream_report_late(spark, sf_dir):
    # Micro-batches of few files each, then a late file for an early day. With a
    # lookback over the whole tree every day is settled by the newest batch.
    ticks = load_ticks(spark, sf_dir, "events")
    late = (F.col("Date") == SINCE) & (F.col("Mnemonic") == "click")
    base, out = scratch_path(spark, "late-tree"), scratch_path(spark, "stream-late")
    days = write_day_tree(ticks.where(~late), base)
    cfg = JobConfig(source_path=base, target_prefix=f"{out}/r_", ledger_path=f"{out}/ledger",
                    first_date=STREAM_FIRST, lookback_days=len(days))
    start = lambda: start_report_stream(spark, cfg, f"{out}/checkpoint", max_files_per_trigger=max(1, len(days) // 5))
    start().awaitTermination()
    ticks.where(late).write.option("header", True).csv(f"{base}/{SINCE}/late")
    start().awaitTermination()
    return published_reports(spark, cfg)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the daily report over the events ticks at sf0.001."""
    apply_required_conf(spark)
    return q_report1(spark, SMOKE_DIR)


def _with_conf(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Run a query under the settings its semantics rely on (UTC days, ANSI)."""
    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_required_conf(spark)
        return fn(spark, sf_dir)
    run_query.__name__ = fn.__name__
    run_query.__doc__ = fn.__doc__
    return run_query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _with_conf(fn) for name, fn in {**_QUERIES, **_LLM_QUERIES}.items()}


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "report1": q_report1,
        "report1_close_change": q_report1_close_change,
        "report1_lineitem": q_report1_lineitem,
        "report1_ties": q_report1_ties,
        "daily_bars": q_daily_bars,
        "sink_csv_lines": q_sink_csv_lines,
        "scan_csv_multiline": q_scan_csv_multiline,
        "ledger_append_reordered": q_ledger_append_reordered,
        "daily_bars_lineitem": q_daily_bars_lineitem,
        "daily_bars_ties": q_daily_bars_ties,
        "daily_bars_ties_text": q_daily_bars_ties_text,
        "daily_bars_lineitem_numeric": q_daily_bars_lineitem_numeric,
        "open_per_tick": q_open_per_tick,
        "prev_open": q_prev_open,
        "day_lag": q_day_lag,
        "change_pct_zero_prev": q_change_pct_zero_prev,
        "round2": q_round2,
        "drop_missing": q_drop_missing,
        "cutoff": q_cutoff,
        "lookup": q_lookup,
        "scan_days": q_scan_days,
        "scan_days_hive": q_scan_days_hive,
        "scan_since": q_scan_since,
        "scan_days_semicolon_latin1": q_scan_days_semicolon_latin1,
        "list_objects": q_list_objects,
        "list_all_objects": q_list_all_objects,
        "list_keys_sizes": q_list_keys_sizes,
        "scan_mixed_headers": q_scan_mixed_headers,
        "scan_absent_days": q_scan_absent_days,
        "union_by_name": q_union_by_name,
        "sink_parquet": q_sink_parquet,
        "sink_csv": q_sink_csv,
        "plan_days": q_plan_days,
        "plan_days_keyed": q_plan_days_keyed,
        "ledger_append": q_ledger_append,
        "date_fns": q_date_fns,
        "job_twice": q_job_twice,
        "job_ledger": q_job_ledger,
        "job_current": q_job_current,
        "job_mapped": q_job_mapped,
        "stream_report": q_stream_report,
        "stream_report_late": q_stream_report_late,
    }


# ---------------------------------------------------------------- oracle SQL
_EV = """select 'U' || user_id as "ISIN", event_type as "Mnemonic", strftime(ts, '%Y-%m-%d') as "Date",
       strftime(ts, '%H:%M:%S.%f') as "Time", value as "StartPrice", value as "EndPrice",
       value as "MinPrice", value as "MaxPrice", event_id as "TradedVolume" from events"""
_EV_HOURLY = """select event_type as "ISIN", event_type as "Mnemonic", strftime(ts, '%Y-%m-%d') as "Date",
       strftime(ts, '%H') as "Time", value as "StartPrice", value as "EndPrice",
       value as "MinPrice", value as "MaxPrice", event_id as "TradedVolume" from events"""
_LI = """select cast(l_suppkey as varchar) as "ISIN", l_returnflag as "Mnemonic",
       strftime(l_shipdate, '%Y-%m-%d') as "Date",
       lpad(cast(l_orderkey as varchar), 12, '0') || '.' || lpad(cast(l_linenumber as varchar), 3, '0') as "Time",
       l_extendedprice as "StartPrice", l_extendedprice as "EndPrice", l_extendedprice as "MinPrice",
       l_extendedprice as "MaxPrice", cast(l_quantity as bigint) as "TradedVolume" from lineitem"""

_NOT_NULL = """"ISIN" is not null and "Mnemonic" is not null and "Date" is not null and "Time" is not null
  and "StartPrice" is not null and not isnan("StartPrice") and "EndPrice" is not null and not isnan("EndPrice")
  and "MinPrice" is not null and not isnan("MinPrice") and "MaxPrice" is not null and not isnan("MaxPrice")
  and "TradedVolume" is not null"""

_BARS = """select "ISIN", "Date",
       first("StartPrice" order by "Time", "StartPrice") as opening_price_eur,
       first("StartPrice" order by "Time" desc, "StartPrice" desc) as closing_price_eur,
       min("MinPrice") as minimum_price_eur, max("MaxPrice") as maximum_price_eur,
       cast(sum("TradedVolume") as bigint) as daily_traded_volume
from ({ticks}) t where """ + _NOT_NULL + """ group by "ISIN", "Date\""""


def _r2(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def _report(ticks: str, cutoff: str, on: str = "opening_price_eur") -> str:
    chg = f"""case when pv is null then null
                   when pv = 0 then case when {on} > 0 then 'inf'::double when {on} < 0 then '-inf'::double end
                   else ({on} - pv) / pv * 100 end"""
    return f"""with g as ({_BARS.format(ticks=ticks)}),
l as (select *, lag({on}) over (partition by "ISIN" order by "Date") as pv from g)
select "ISIN", "Date", {_r2('opening_price_eur')} as opening_price_eur,
       {_r2('closing_price_eur')} as closing_price_eur, {_r2('minimum_price_eur')} as minimum_price_eur,
       {_r2('maximum_price_eur')} as maximum_price_eur, daily_traded_volume,
       {_r2(chg)} as "change_prev_closing_%"
from l where "Date" >= '{cutoff}'"""


_ORDER_DAYS = "select distinct cast(o_orderdate as date) as d from orders"


def _orders_plan(select: str) -> str:
    return f"""with od as ({_ORDER_DAYS}),
cal as (select unnest(generate_series(date '{ORDERS_FIRST}' - 1, date '{ORDERS_AS_OF}', interval 1 day))::date as d),
m as (select min(d) as m from cal where d >= date '{ORDERS_FIRST}' and d not in (select d from od))
{select}"""


def oracle_sql() -> dict[str, str]:
    days = ", ".join(f"'{d}'" for d in SCAN_DAYS)
    ev_zero = _EV.replace('value as "StartPrice"',
                          'case when event_type = \'error\' then 0.0 else value end as "StartPrice"')
    return {
        "report1": _report(_EV, CUTOFF),
        "report1_close_change": _report(_EV, CUTOFF, on="closing_price_eur"),
        "report1_lineitem": _report(_LI, "1996-01-01"),
        "report1_ties": _report(_EV_HOURLY, CUTOFF),
        "daily_bars": _BARS.format(ticks=_EV),
        "daily_bars_lineitem": _BARS.format(ticks=_LI),
        "daily_bars_ties": _BARS.format(ticks=_EV_HOURLY),
        "daily_bars_ties_text": _BARS.format(ticks=_EV_HOURLY),
        "daily_bars_lineitem_numeric": _BARS.format(ticks=_LI),
        "open_per_tick": f"""select t.*, first("StartPrice" order by "Time", "StartPrice")
                                 over (partition by "ISIN", "Date") as opening_price_eur from ({_EV}) t""",
        "prev_open": f"""select *, lag(opening_price_eur) over (partition by "ISIN" order by "Date") as prev_open
                         from ({_BARS.format(ticks=_EV)}) b""",
        "day_lag": f"""with d as (select "Date", count(*) as n_ticks, max("MaxPrice") as high,
                                         cast(sum("TradedVolume") as bigint) as volume
                                  from ({_EV}) t group by "Date")
                       select *, lag(n_ticks) over (order by "Date") as n_ticks_prev,
                              lag(high) over (order by "Date") as high_prev from d""",
        "change_pct_zero_prev": _report(ev_zero, CUTOFF),
        "round2": """select l_orderkey, l_linenumber,
                            round_even(l_extendedprice * (1 - l_discount) * 100, 0) / 100 as net,
                            round_even(l_extendedprice * l_tax * 100, 0) / 100 as tax,
                            round_even(l_quantity * 100, 0) / 100 as l_quantity,
                            round(l_quantity / 8, 2) as net_half_up,
                            round_even(l_quantity / 8 * 100, 0) / 100 as qty_eighths from lineitem""",
        "drop_missing": f"""select * replace (nullif("Mnemonic", 'error') as "Mnemonic",
                                              nullif("EndPrice", 1.0) as "EndPrice")
                            from ({_EV}) t where nullif("Mnemonic", 'error') is not null
                                             and nullif("EndPrice", 1.0) is not null""",
        "cutoff": f"""select * from ({_BARS.format(ticks=_EV)}) b where "Date" >= '{CUTOFF}'""",
        "lookup": f"""select * from ({_report(_EV, CUTOFF)}) r where "ISIN" = '{LOOKUP_ISIN}'""",
        "scan_days": f"""select * from ({_EV}) t where "Date" in ({days})""",
        "scan_days_hive": f"""select * from ({_EV}) t where "Date" in ({days})""",
        "scan_since": f"""select * from ({_EV}) t where "Date" >= '{SINCE}'""",
        "list_objects": """select distinct strftime(ts, '%Y-%m-%d') as day from events
                           where strftime(ts, '%Y-%m-%d') like '2024-01%'""",
        "scan_days_semicolon_latin1": f"""select * from ({_EV}) t where "Date" in ({days})""",
        "list_all_objects": """select distinct strftime(ts, '%Y-%m-%d') as day, 'csv' as ext from events""",
        "list_keys_sizes": """select 'day=' || day || '/event_type=' || event_type || '/part' as key, sum(bytes)::bigint as size
                              from (select strftime(ts, '%Y-%m-%d') as day, event_type, strlen(event_id || ',' || user_id) + 1 as bytes from events)
                              group by day, event_type union all select '_SUCCESS', 0""",
        "scan_mixed_headers": _EV,
        "scan_absent_days": f"""select * from ({_EV}) t where "Date" = '{SCAN_DAYS[0]}'""",
        "union_by_name": f"""select * from ({_EV}) a union all by name
                             select "ISIN", "Date", "StartPrice", "TradedVolume" from ({_LI}) b""",
        "sink_parquet": _report(_LI, "1996-01-01"),
        "sink_csv": _EV,
        "plan_days": _orders_plan("""select strftime(d, '%Y-%m-%d') as day, strftime(m.m, '%Y-%m-%d') as cutoff
                                     from cal, m where d >= m.m - 1"""),
        "plan_days_keyed": f"""with t as (select distinct 'U' || user_id as isin, cast(ts as date) as d from events),
k as (select distinct isin from t),
kc as (select isin, unnest(generate_series(date '{KEYED_FIRST}' - 1, date '{KEYED_AS_OF}', interval 1 day))::date as d from k),
m as (select isin, min(d) as m from kc where d >= date '{KEYED_FIRST}'
        and not exists (select 1 from t where t.isin = kc.isin and t.d = kc.d) group by isin)
select kc.isin as "ISIN", strftime(kc.d, '%Y-%m-%d') as day, strftime(m.m, '%Y-%m-%d') as cutoff
from kc join m on kc.isin = m.isin where kc.d >= m.m - 1""",
        "ledger_append": _orders_plan(f"""select strftime(d, '%Y-%m-%d') as source_file_date,
                                                '{ORDERS_STAMP}' as datetime_of_processing from od
                                         union all
                                         select strftime(d, '%Y-%m-%d'), '{ORDERS_AS_OF}' from cal, m where d >= m.m"""),
        "ledger_append_reordered": _orders_plan(f"""select strftime(d, '%Y-%m-%d') as source_file_date,
                                                '{ORDERS_STAMP}' as datetime_of_processing from od
                                         union all
                                         select strftime(d, '%Y-%m-%d'), '{ORDERS_AS_OF}' from cal, m where d >= m.m"""),
        "sink_csv_lines": """select event_id || ',"' || ' ' || replace(props, '"', '""') || '"' as line from events
                             where props is not null""",
        "scan_csv_multiline": "select cast(page_id as varchar) as page_id, html from pages",
        "date_fns": f"""select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day,
                               strftime(cast(o_orderdate as date) + 1, '%Y-%m-%d') as next_day,
                               strftime(cast(o_orderdate as date) - 1, '%Y-%m-%d') as prev_day,
                               cast(date '{ORDERS_AS_OF}' - cast(o_orderdate as date) as integer) as days_to_as_of,
                               strftime(o_orderdate, '%Y%m%d_%H%M%S') as stamp,
                               split_part(strftime(o_orderdate, '%Y-%m-%d') || '/' || o_orderpriority, '/', 1) as key_day,
                               cast(o_orderdate as date) >= date '1998-01-01' as after_1998
                        from orders""",
        # The job reads one lookback day before first_date, no more.
        "job_twice": _report(f"""select * from ({_EV}) e where "Date" between '{JOB_LOOKBACK}' and '{JOB_AS_OF}'""",
                             JOB_FIRST),
        "job_ledger": f"""select strftime(d, '%Y-%m-%d') as source_file_date,
                                 case when d <= date '{LEDGER_FIRST_RUN}' then '{LEDGER_FIRST_RUN}' else '{JOB_AS_OF}' end as datetime_of_processing
                          from (select unnest(generate_series(date '{JOB_FIRST}', date '{JOB_AS_OF}', interval 1 day))::date as d)""",
        "job_current": f"""select *, "Date" as report_day from (
            select * from ({_report(f"""select * from ({_EV}) e where "Date" between
                '{JOB_LOOKBACK}' and '{LEDGER_FIRST_RUN}'""", JOB_FIRST)}) a
            where "Date" < '{CURRENT_AGAIN}'
            union all
            select * from ({_report(f"""select * from ({_EV}) e where "Date" between
                cast(date '{CURRENT_AGAIN}' - 1 as varchar) and '{JOB_AS_OF}'""", CURRENT_AGAIN)}) b) r""",
        "job_mapped": f"""select *, 'report1/mapped_20240201_060001.parquet' as target
                          from ({_report(f"select * from ({_EV}) e where \"Date\" <= '{JOB_AS_OF}'", MAPPED_FIRST_RUN)}) r""",
        "stream_report": _report(_EV, STREAM_FIRST),
        "stream_report_late": _report(_EV, STREAM_FIRST),
        **_LLM_SQL,
    }
