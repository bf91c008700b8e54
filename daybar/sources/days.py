"""Scans of a day-keyed source tree: a planned set of days, or all days since a cutoff."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybar.config import SourceColumns
from daybar.sources.csv import cast_ticks, empty_ticks, read_csv, read_csv_by_name
from daybar.sources.listing import escape_glob

_DAY = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def day_glob(base: str, days: list[str]) -> str:
    """``base/{d1,d2,...}*``: every key that starts with one of the days."""
    alts = ",".join(escape_glob(d) for d in days)
    return f"{base.rstrip('/')}/{{{alts}}}*"


def _read_any(spark: SparkSession, paths, fmt: str, src: SourceColumns, *, recursive: bool, sep: str, encoding: str,
              header=None, tree: str | None = None) -> DataFrame | None:
    if fmt == "csv":
        if header:  # declared: every file is checked against it
            return read_csv(spark, paths, sep=sep, encoding=encoding, recursive=recursive, na_tokens=False, header=header, tree=tree)
        return read_csv_by_name(spark, paths, src.columns, sep=sep, encoding=encoding, recursive=recursive, tree=tree)
    if fmt == "parquet":
        r = spark.read.option("basePath", tree) if tree else spark.read
        if recursive:
            r = r.option("recursiveFileLookup", True)
        try:
            return r.parquet(*([paths] if isinstance(paths, str) else paths))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
    raise ValueError(f"unsupported source format {fmt!r}")


def _hive(spark: SparkSession, paths: str, src: SourceColumns, fmt: str, sep: str, encoding: str, tree: str) -> DataFrame | None:
    """Folders ``<date column>=<day>``; the day is text again."""
    rest = [c for c in (src.file_columns or ()) if c != src.date]
    day = F.date_format(F.col(f"`{src.date}`"), "yyyy-MM-dd")
    raw = _read_any(spark, paths, fmt, src, recursive=False, sep=sep, encoding=encoding, header=rest or None, tree=tree)
    return None if raw is None else raw.withColumn(src.date, day)


def read_days(spark: SparkSession, base: str, days: list[str], src: SourceColumns = SourceColumns(), *,
              layout: str = "prefix", fmt: str = "csv", sep: str = ",", encoding: str = "utf-8",
              drop_missing: bool = False) -> DataFrame:
    """Typed ticks of the planned days; days without files add nothing.

    ``layout="prefix"``: keys ``<day>...`` (e.g. ``2021-04-17/…_XETR13.csv``);
    one glob lists only the planned days. ``layout="hive"``: folders
    ``<date column>=<day>``; only the planned days' folders are listed.
    CSV columns are found by name in each file's own header (``read_csv_by_name``),
    unless ``src.file_columns`` declares one header that all files must have.
    ``drop_missing`` drops ticks with a missing value in
    any selected column while they are still text (see ``cast_ticks``).
    """
    days = sorted(set(days))
    if not days:
        return empty_ticks(spark, src)
    if layout == "hive":
        planned = f"{base.rstrip('/')}/{escape_glob(src.date)}={{{','.join(map(escape_glob, days))}}}"
        raw = _hive(spark, planned, src, fmt, sep, encoding, base)
        raw = None if raw is None else raw.where(F.col(f"`{src.date}`").isin(days))
    elif layout == "prefix":
        raw = _read_any(spark, day_glob(base, days), fmt, src, recursive=True, sep=sep, encoding=encoding, header=src.file_columns)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return empty_ticks(spark, src) if raw is None else cast_ticks(raw, src, drop_missing=drop_missing)


def top_level_days(spark: SparkSession, base: str) -> list[tuple[str, str]]:
    """(day, path) of every top-level entry of ``base`` whose name starts with a day.

    One non-recursive listing of ``base``; its size is one entry per day (or
    per flat file), never the whole tree.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        head = name[:10]
        if _DAY.match(head) and not name.startswith(("_", ".")):
            try:
                _dt.date.fromisoformat(head)
            except ValueError:
                continue
            out.append((head, str(st.getPath().toString())))
    return sorted(out)


def read_since(spark: SparkSession, base: str, cutoff: str, src: SourceColumns = SourceColumns(), *,
               layout: str = "prefix", fmt: str = "csv", sep: str = ",", encoding: str = "utf-8",
               drop_missing: bool = False) -> DataFrame:
    """Typed ticks of every day on or after ``cutoff``.

    Prefix layout: the top level of ``base`` is listed once and the entries
    whose name (read as a day) is on or after the cutoff are scanned; keys
    that do not start with a day are skipped. Hive layout: a partition
    filter, pruned by Spark at planning time.
    """
    if layout == "hive":
        raw = _hive(spark, base, src, fmt, sep, encoding, base)
        raw = None if raw is None else raw.where(F.col(f"`{src.date}`") >= F.lit(cutoff))
    else:
        paths = [p for d, p in top_level_days(spark, base) if d >= cutoff]
        raw = _read_any(spark, paths, fmt, src, recursive=True, sep=sep, encoding=encoding, header=src.file_columns) if paths else None
    return empty_ticks(spark, src) if raw is None else cast_ticks(raw, src, drop_missing=drop_missing)


def write_day_tree(ticks: DataFrame, base: str, src: SourceColumns = SourceColumns(), *,
                   layout: str = "prefix", fmt: str = "csv", sep: str = ",",
                   encoding: str = "utf-8", append: bool = False) -> list[str]:
    """Lay ticks out as a day-keyed tree; returns the days written.

    ``hive``: ``base/<Date>=<day>/part-*``. ``prefix``: ``base/<day>/part-*``
    with the day column kept inside the files, as in the reference's bucket.
    Both are one distributed write partitioned by day; the prefix form then
    renames the day folders (one rename per day, no data copied). ``append``
    adds days (or, to the hive layout, files) to a tree that is there.
    """
    mode = "append" if append else "errorifexists"
    spark = ticks.sparkSession
    opts = {"header": "true", "sep": sep, "encoding": encoding} if fmt == "csv" else {}
    if layout == "hive":
        ticks.write.mode(mode).options(**opts).partitionBy(src.date).format(fmt).save(base)
        part = src.date
    elif layout == "prefix":
        (ticks.withColumn("__day", F.col(src.date)).write.mode(mode).options(**opts)
         .partitionBy("__day").format(fmt).save(base))
        part = "__day"
    else:
        raise ValueError(f"unknown layout {layout!r}")
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(part + "="):
            day = name.split("=", 1)[1]
            days.append(day)
            if layout == "prefix":
                fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(root, day))
    return sorted(days)
