"""Physical plan properties the design relies on at scale."""

import re

import pytest

from daybar.config import SourceColumns
from daybar.operators import daily_bars, daily_report, frame_lag, open_per_tick
from daybar.plans import plan_days_keyed
from daybar.sources import load_ticks, read_days, write_day_tree


def _plan(df, capsys, mode="simple"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def test_report_plan_two_exchanges_and_cutoff_above_window(spark, capsys):
    df = daily_report(load_ticks(spark, "/root/testdata/sf0.001", "events"), cutoff="2024-01-10")
    plan = _plan(df, capsys)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert "hashpartitioning(ISIN#" in plan and "Broadcast" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # partial aggregation below the first exchange (map-side combine)
    assert re.search(r"partial_min\(__tick_order", plan)
    # the cutoff filter is applied after the window, never pushed below it
    lines = plan.splitlines()
    w = next(i for i, ln in enumerate(lines) if "Window [" in ln)
    f = next(i for i, ln in enumerate(lines) if "Filter" in ln and "2024-01-10" in ln)
    assert f < w
    # only the columns the report needs are read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_hive_scan_prunes_partitions(spark, capsys, tmp_dir):
    base = f"{tmp_dir}/tree"
    write_day_tree(load_ticks(spark, "/root/testdata/sf0.001", "events"), base, layout="hive")
    df = read_days(spark, base, ["2024-01-05", "2024-01-06"], layout="hive", drop_missing=True)
    plan = _plan(df, capsys, "formatted")
    assert re.search(r"PartitionFilters: \[[^\]]*IN \(2024-01-05,2024-01-06\)", plan)


def test_prefix_scan_lists_only_planned_days(spark, capsys, tmp_dir):
    base = f"{tmp_dir}/tree"
    write_day_tree(load_ticks(spark, "/root/testdata/sf0.001", "events"), base)
    df = read_days(spark, base, ["2024-01-05", "2024-01-06"])
    roots = set(re.findall(r"/tree/(\d{4}-\d{2}-\d{2})", df.inputFiles().__str__()))
    assert roots == {"2024-01-05", "2024-01-06"}


def test_open_per_tick_has_no_window_over_instrument_day(spark, capsys):
    plan = _plan(open_per_tick(load_ticks(spark, "/root/testdata/sf0.001", "events")), capsys)
    assert "Window" not in plan and "Join" in plan


def test_unique_times_are_a_hash_aggregation(spark, capsys):
    ticks = load_ticks(spark, "/root/testdata/sf0.001", "events")
    plan = _plan(daily_bars(ticks, SourceColumns(time_order="unique_clock")), capsys)
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort " not in plan


def test_frame_lag_is_built_without_a_job_and_scans_once(spark, capsys):
    days = load_ticks(spark, "/root/testdata/sf0.001", "events").groupBy("Date").count()
    spark.sparkContext.setJobGroup("frame-lag", "plan only")
    df = frame_lag(days, "Date", ["count"])
    df.schema
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("frame-lag")) == []
    df.collect()
    spark.sparkContext.setJobGroup("", "")
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan parquet") == 1


def test_keyed_planner_has_no_cross_join(spark, capsys):
    t = load_ticks(spark, "/root/testdata/sf0.001", "events")
    led = t.selectExpr("ISIN", "Date as source_file_date", "'x' as datetime_of_processing")
    plan = _plan(plan_days_keyed(t, led, "2024-01-02", "2024-01-30"), capsys)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Generate explode" in plan
