"""Views of the driver tables in the tick schema.

Each adapter is a projection over a Parquet scan, so Spark prunes the
columns it does not use and the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybar.config import SourceColumns

TICK_COLUMNS = ("ISIN", "Mnemonic", "Date", "Time", "StartPrice",
                "EndPrice", "MinPrice", "MaxPrice", "TradedVolume")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ticks(isin, mnemonic, date, time, price, volume) -> list:
    return [isin.alias("ISIN"), mnemonic.alias("Mnemonic"), date.alias("Date"), time.alias("Time"),
            price.alias("StartPrice"), price.alias("EndPrice"), price.alias("MinPrice"),
            price.alias("MaxPrice"), volume.cast("bigint").alias("TradedVolume")]


def events_ticks(events: DataFrame) -> DataFrame:
    """One instrument per user; time to the microsecond (no ties)."""
    ts = F.col("ts")
    return events.select(*_ticks(
        F.concat(F.lit("U"), F.col("user_id").cast("string")), F.col("event_type"),
        F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss.SSSSSS"),
        F.col("value"), F.col("event_id")))


def events_hourly_ticks(events: DataFrame) -> DataFrame:
    """One instrument per event type; time truncated to the hour (many ties)."""
    ts = F.col("ts")
    return events.select(*_ticks(
        F.col("event_type"), F.col("event_type"), F.date_format(ts, "yyyy-MM-dd"),
        F.date_format(ts, "HH"), F.col("value"), F.col("event_id")))


def lineitem_ticks(lineitem: DataFrame) -> DataFrame:
    """One instrument per supplier, one day per ship date; sparse groups."""
    tm = F.concat(F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.lit("."),
                  F.lpad(F.col("l_linenumber").cast("string"), 3, "0"))
    return lineitem.select(*_ticks(
        F.col("l_suppkey").cast("string"), F.col("l_returnflag"),
        F.date_format(F.col("l_shipdate"), "yyyy-MM-dd"), tm,
        F.col("l_extendedprice"), F.col("l_quantity")))


def load_ticks(spark: SparkSession, sf_dir: str, kind: str = "events") -> DataFrame:
    if kind == "events":
        return events_ticks(table(spark, sf_dir, "events"))
    if kind == "events_hourly":
        return events_hourly_ticks(table(spark, sf_dir, "events"))
    if kind == "lineitem":
        return lineitem_ticks(table(spark, sf_dir, "lineitem"))
    raise ValueError(f"unknown tick adapter {kind!r}")


# lineitem's Time is 12 + 3 zero-padded digits: as a number it sorts like the text.
LINEITEM_TIME_ORDER = "cast(replace(Time, '.', '') as bigint)"


def source_columns(kind: str = "events") -> SourceColumns:
    """Column settings for an adapter's ticks (text ordering, the default)."""
    return SourceColumns()
