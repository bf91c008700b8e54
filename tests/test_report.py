import math

import pytest
from pyspark.sql import functions as F

from daybar.config import SourceColumns
from daybar.functions.numeric import round_dp
from daybar.operators import daily_bars, daily_report, frame_lag, open_per_tick
from tests.fixtures import F1, F2, F2_CLOSE_CHANGE, REPORT_COLUMNS, TICK_DDL


def _ticks(spark, rows=F1):
    return spark.createDataFrame(rows, TICK_DDL)


def _rows(df):
    return [tuple(r) for r in df.orderBy("ISIN", "Date").collect()]


def test_golden_report(spark):
    out = daily_report(_ticks(spark, F1[1:]), cutoff="2021-04-17")
    assert out.columns == REPORT_COLUMNS
    assert _rows(out) == F2
    assert dict(out.dtypes)["daily_traded_volume"] == "bigint"


def test_closing_based_change(spark):
    out = daily_report(_ticks(spark, F1[1:]), cutoff="2021-04-17", change_on="close")
    assert [r[-1] for r in _rows(out)] == F2_CLOSE_CHANGE


def test_empty_input_gives_empty_report(spark):
    out = daily_report(spark.createDataFrame([], TICK_DDL), cutoff="2021-04-17")
    assert out.columns == REPORT_COLUMNS
    assert out.count() == 0


def test_first_row_without_previous_day_is_null(spark):
    out = _rows(daily_report(_ticks(spark, F1[1:])))
    assert out[0][1] == "2021-04-16" and out[0][-1] is None


def test_rounding_is_half_even_on_the_scaled_double(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (1.005,), (-0.125,), (0.135,)], "x double")
    got = [r[0] for r in df.select(round_dp("x").alias("r")).collect()]
    assert got == [0.12, 2.68, 1.0, -0.12, 0.14]


def test_zero_previous_open(spark):
    rows = [("Z", "N", "2021-01-01", "09:00", 0.0, 1.0, 0.0, 1.0, 1),
            ("Z", "N", "2021-01-02", "09:00", 5.0, 1.0, 0.0, 1.0, 1),
            ("Y", "N", "2021-01-01", "09:00", 0.0, 1.0, 0.0, 1.0, 1),
            ("Y", "N", "2021-01-02", "09:00", 0.0, 1.0, 0.0, 1.0, 1),
            ("X", "N", "2021-01-01", "09:00", 0.0, 1.0, 0.0, 1.0, 1),
            ("X", "N", "2021-01-02", "09:00", -2.0, 1.0, 0.0, 1.0, 1)]
    out = {r[0]: r[-1] for r in _rows(daily_report(_ticks(spark, rows), cutoff="2021-01-02"))}
    assert out["Z"] == math.inf and out["Y"] is None and out["X"] == -math.inf


def test_missing_values_drop_the_whole_tick(spark):
    rows = list(F1[1:]) + [
        ("AT0000A0E9W5", None, "2021-04-19", "06:00", 1.0, 1.0, 1.0, 99.0, 5),   # missing Mnemonic
        ("AT0000A0E9W5", "SANT", "2021-04-19", "06:30", 1.0, None, 1.0, 99.0, 5),  # missing EndPrice
        ("AT0000A0E9W5", "SANT", "2021-04-19", "06:45", float("nan"), 1.0, 1.0, 99.0, 5),
    ]
    assert _rows(daily_report(_ticks(spark, rows), cutoff="2021-04-17")) == F2


@pytest.mark.parametrize("order", ["clock", "text"])
def test_ties_on_time_are_broken_by_price(spark, order):
    rows = [("T", "N", "2021-01-01", "09:00", 3.0, 1.0, 1.0, 9.0, 1),
            ("T", "N", "2021-01-01", "09:00", -2.0, 1.0, 1.0, 9.0, 1),
            ("T", "N", "2021-01-01", "09:00", 2.0, 1.0, 1.0, 9.0, 1),
            ("T", "N", "2021-01-01", "10:00", 7.0, 1.0, 1.0, 9.0, 1),
            ("T", "N", "2021-01-01", "10:00", 8.0, 1.0, 1.0, 9.0, 1),
            ("T", "N", "2021-01-01", "10:00", 7.5, 1.0, 1.0, 9.0, 1)]
    src = SourceColumns(time_order=order)
    for parts in (1, 3):
        r = _rows(daily_bars(_ticks(spark, rows).repartition(parts), src))[0]
        assert (r[2], r[3]) == (-2.0, 8.0)


@pytest.mark.parametrize("order", ["clock", "text"])
def test_both_orderings_give_the_golden_report(spark, order):
    out = daily_report(_ticks(spark, F1[1:]), SourceColumns(time_order=order), cutoff="2021-04-17")
    assert _rows(out) == F2


def test_clock_formats_and_bad_time(spark):
    from daybar.functions.ordering import clock_micros
    df = spark.createDataFrame([("07",), ("07:05",), ("07:05:09",), ("07:05:09.5",), ("07:05:09.000123",)], "t string")
    got = [r[0] for r in df.select(clock_micros(F.col("t"))).collect()]
    assert got == [25200000000, 25500000000, 25509000000, 25509500000, 25509000123]
    bad = spark.createDataFrame([("7:05",)], "t string")
    with pytest.raises(Exception):
        bad.select(clock_micros(F.col("t"))).collect()


def test_instrument_skipping_a_day_compares_with_its_last_trading_day(spark):
    rows = [("A", "N", "2021-01-04", "09:00", 10.0, 1.0, 1.0, 1.0, 1),
            ("A", "N", "2021-01-05", "09:00", 11.0, 1.0, 1.0, 1.0, 1),
            ("A", "N", "2021-01-06", "09:00", 12.1, 1.0, 1.0, 1.0, 1),
            ("B", "N", "2021-01-04", "09:00", 20.0, 1.0, 1.0, 1.0, 1),
            ("B", "N", "2021-01-06", "09:00", 30.0, 1.0, 1.0, 1.0, 1)]
    out = {(r[0], r[1]): r[-1] for r in _rows(daily_report(_ticks(spark, rows), cutoff="2021-01-05"))}
    assert out == {("A", "2021-01-05"): 10.0, ("A", "2021-01-06"): 10.0, ("B", "2021-01-06"): 50.0}


def test_batch_starting_after_non_trading_day_has_null_change(spark):
    # Lookback is one calendar day: a Monday batch reads Sunday, which has no ticks.
    rows = [("A", "N", "2021-04-16", "09:00", 10.0, 1.0, 1.0, 1.0, 1),   # Friday, not read
            ("A", "N", "2021-04-19", "09:00", 11.0, 1.0, 1.0, 1.0, 1)]   # Monday
    read = _ticks(spark, rows).where(F.col("Date") >= "2021-04-18")
    assert _rows(daily_report(read, cutoff="2021-04-19"))[0][-1] is None


def test_open_per_tick(spark):
    out = open_per_tick(_ticks(spark, F1[1:]))
    got = sorted((r["Date"], r["Time"], r["opening_price_eur"]) for r in out.collect())
    assert got[1:3] == [("2021-04-17", "13:00", 20.21), ("2021-04-17", "14:00", 20.21)]
    assert out.count() == 8


def test_frame_lag_matches_a_serial_shift(spark):
    days = spark.range(0, 200).select(F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") * 3).cast("int")).alias("day"),
                                      (F.col("id") * 1.5).alias("v"))
    out = frame_lag(days, "day", ["v"], buckets=7).orderBy("day").collect()
    assert out[0]["v_prev"] is None
    assert all(out[i]["v_prev"] == out[i - 1]["v"] for i in range(1, len(out)))


@pytest.mark.parametrize("cutoff,n", [("2021-04-16", 4), ("2021-04-19", 1), ("2021-05-01", 0)])
def test_cutoff_applies_after_the_lag(spark, cutoff, n):
    out = _rows(daily_report(_ticks(spark, F1[1:]), cutoff=cutoff))
    assert len(out) == n
    if n == 1:
        assert out[0][-1] == 14.58
