import os

from daybar.config import JobConfig
from daybar.streaming import published_reports, start_report_stream
from tests.fixtures import F1, F2, write_tick_csvs


def test_stream_reports_new_days_then_late_files(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    write_tick_csvs(src, F1[:4])  # 04-15 … 04-17 (13:00)
    cfg = JobConfig(source_path=src, target_prefix=f"{tmp_dir}/trg/report1/r_", ledger_path=f"{tmp_dir}/unused",
                    first_date="2021-04-17")
    ck = f"{tmp_dir}/ck"
    q = start_report_stream(spark, cfg, ck)
    q.awaitTermination()
    first = {r["Date"]: tuple(r) for r in published_reports(spark, cfg).collect()}
    assert sorted(first) == ["2021-04-17"]
    # New files arrive (04-18, 04-19): only those days are reported, with the lookback day read back.
    write_tick_csvs(src, F1[4:])
    q = start_report_stream(spark, cfg, ck)
    q.awaitTermination()
    rows = sorted(tuple(r) for r in published_reports(spark, cfg).collect())
    assert rows == sorted(F2)


def test_late_file_for_a_reported_day_is_reported_again(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    write_tick_csvs(src, F1[1:3])  # 04-16, 04-17 13:00
    cfg = JobConfig(source_path=src, target_prefix=f"{tmp_dir}/trg/r_", ledger_path=f"{tmp_dir}/unused",
                    first_date="2021-04-17")
    ck = f"{tmp_dir}/ck"
    start_report_stream(spark, cfg, ck).awaitTermination()
    first = [tuple(r) for r in published_reports(spark, cfg).collect()]
    assert [r[1] for r in first] == ["2021-04-17"] and first[0][3] == 20.21  # close = only tick so far
    # The 14:00 file for 04-17 arrives late: the day is recomputed in full.
    write_tick_csvs(src, [F1[3]], names=["2021-04-17/2021-04-17_BINS_XETR14.csv"])
    start_report_stream(spark, cfg, ck).awaitTermination()
    rows = sorted(tuple(r) for r in published_reports(spark, cfg).collect())
    assert rows == [F2[0]]  # one row: that of the newest batch


def test_stream_over_hive_layout(spark, tmp_dir):
    from daybar.sources import write_day_tree
    from tests.fixtures import TICK_DDL
    src = f"{tmp_dir}/src"
    write_day_tree(spark.createDataFrame(F1[1:], TICK_DDL), src, layout="hive")
    cfg = JobConfig(source_path=src, target_prefix=f"{tmp_dir}/trg/r_", ledger_path=f"{tmp_dir}/unused",
                    first_date="2021-04-17", source_layout="hive")
    start_report_stream(spark, cfg, f"{tmp_dir}/ck").awaitTermination()
    assert sorted(tuple(r) for r in published_reports(spark, cfg).collect()) == sorted(F2)


def test_stream_over_parquet_trees(spark, tmp_dir):
    from daybar.sources import write_day_tree
    from tests.fixtures import TICK_DDL
    for layout in ("prefix", "hive"):
        src = f"{tmp_dir}/{layout}/src"
        write_day_tree(spark.createDataFrame(F1[1:], TICK_DDL), src, layout=layout, fmt="parquet")
        cfg = JobConfig(source_path=src, target_prefix=f"{tmp_dir}/{layout}/trg/r_", ledger_path=f"{tmp_dir}/x",
                        first_date="2021-04-17", source_layout=layout, source_format="parquet")
        start_report_stream(spark, cfg, f"{tmp_dir}/{layout}/ck").awaitTermination()
        assert sorted(tuple(r) for r in published_reports(spark, cfg).collect()) == sorted(F2), layout


def test_change_never_reaches_across_days_that_were_not_read(spark, tmp_dir):
    src = f"{tmp_dir}/src"

    def tick(day, price):
        return ("I", "M", day, "09:00", price, price, price, price, 1)

    def add(day, price, name):
        write_tick_csvs(src, [tick(day, price)], names=[f"{day}/{day}_{name}.csv"])

    cfg = JobConfig(source_path=src, target_prefix=f"{tmp_dir}/trg/r_", ledger_path=f"{tmp_dir}/unused", first_date="2021-04-01")
    add("2021-04-05", 10.0, "a")
    add("2021-04-06", 15.0, "a")
    add("2021-04-07", 20.0, "a")
    start_report_stream(spark, cfg, f"{tmp_dir}/ck").awaitTermination()
    add("2021-04-09", 40.0, "a")
    write_tick_csvs(src, [("I", "M", "2021-04-05", "08:00", 5.0, 5.0, 5.0, 5.0, 1)], names=["2021-04-05/2021-04-05_late.csv"])
    start_report_stream(spark, cfg, f"{tmp_dir}/ck").awaitTermination()
    change = {r["Date"]: r["change_prev_closing_%"] for r in published_reports(spark, cfg).collect()}
    # The day after the late one is recomputed; the 9th has nothing on its lookback day.
    assert change == {"2021-04-05": None, "2021-04-06": 200.0, "2021-04-07": 33.33, "2021-04-09": None}


def test_one_row_for_a_day_whose_files_come_in_several_batches(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    write_tick_csvs(src, F1[1:])
    cfg = JobConfig(source_path=src, target_prefix=f"{tmp_dir}/trg/r_", ledger_path=f"{tmp_dir}/unused", first_date="2021-04-17")
    start_report_stream(spark, cfg, f"{tmp_dir}/ck", max_files_per_trigger=1).awaitTermination()
    assert sorted(tuple(r) for r in published_reports(spark, cfg).collect()) == sorted(F2)


def test_files_not_keyed_by_a_calendar_day_are_passed_over(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    write_tick_csvs(src, F1[1:])
    write_tick_csvs(src, F1[:1], names=["2021-02-31/x.csv"])
    cfg = JobConfig(source_path=src, target_prefix=f"{tmp_dir}/trg/r_", ledger_path=f"{tmp_dir}/unused", first_date="2021-04-17")
    start_report_stream(spark, cfg, f"{tmp_dir}/ck").awaitTermination()
    assert sorted(tuple(r) for r in published_reports(spark, cfg).collect()) == sorted(F2)


def test_the_stream_opens_no_file_to_learn_its_days(spark, tmp_dir):
    # A file that no reader could read: its path is enough to plan the batch, and its day is not asked for.
    write_tick_csvs(f"{tmp_dir}/src", F1)
    os.makedirs(f"{tmp_dir}/src/2020-01-01")
    with open(f"{tmp_dir}/src/2020-01-01/broken.csv", "wb") as fh:
        fh.write(b"\xff\xfe not,a,\"table\n" * 10)
    cfg = JobConfig(source_path=f"{tmp_dir}/src", target_prefix=f"{tmp_dir}/trg/r_", ledger_path=f"{tmp_dir}/led",
                    first_date="2021-04-17")
    start_report_stream(spark, cfg, f"{tmp_dir}/ck").awaitTermination()
    assert sorted(r["Date"] for r in published_reports(spark, cfg).collect()) == ["2021-04-17", "2021-04-18", "2021-04-19"]
