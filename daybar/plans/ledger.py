"""The ledger of processed days: an append-only CSV folder.

Each run appends one small part file (``mode("append")``), so nothing is
ever read and rewritten in place and a failed run leaves the old rows intact.
Readers take the distinct set of days.
"""

from __future__ import annotations

from collections import Counter

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybar.config import LEDGER_DAY_COL, LEDGER_PROCESSED_COL
from daybar.errors import LedgerLayoutError, LedgerSchemaError
from daybar.functions.dates import as_of_string
from daybar.session import path_exists
from daybar.sources.csv import string_schema

LEDGER_COLUMNS = (LEDGER_DAY_COL, LEDGER_PROCESSED_COL)


def _header(spark: SparkSession, path: str) -> list[str] | None:
    try:
        return spark.read.option("header", True).csv(path).columns or None
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "PATH_NOT_FOUND" in str(e):
            return None
        raise


def read_ledger(spark: SparkSession, path: str, keys: tuple[str, ...] = (),
                ordered: bool = False) -> DataFrame | None:
    """Ledger rows as strings, or ``None`` when there is no ledger yet.

    The header must hold exactly the ledger columns (plus ``keys``), in any
    order; every part file is then checked against it while it is read.
    ``ordered`` returns rows in append order: older part files first, and
    days ascending within a part file (each run appends its days in that
    order). Planning only needs the set, so it does not ask for it.
    """
    if not path_exists(spark, path):
        return None
    header = _header(spark, path)
    if header is None:
        return None
    expected = [*keys, *LEDGER_COLUMNS]
    if Counter(header) != Counter(expected):
        raise LedgerSchemaError(f"ledger columns {header} != {expected}")
    df = (spark.read.schema(string_schema(header)).option("header", True)
          .option("enforceSchema", False).option("mode", "FAILFAST").csv(path))
    if ordered:
        df = df.orderBy(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"),
                        *[F.col(k) for k in keys], F.col(LEDGER_DAY_COL))
    return df.select(*expected)


# The forms of a ledger day: year first, parts by the same of - / . or eight digits, and a time of day that is cut off.
_TIME = r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?: ?(?:Z|[+-]\d{2}:?\d{2}))?)?$"
_PARTED = r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})" + _TIME
_DIGITS = r"^(\d{4})(\d{2})(\d{2})" + _TIME


def ledger_day(text: Column) -> Column:
    """The DATE that a ledger day states in one of the forms above; null for any other text."""
    t = F.trim(text)
    part = lambda form, *groups: F.concat_ws("-", *(F.regexp_extract(t, form, g) for g in groups))
    iso = F.when(t.rlike(_PARTED), part(_PARTED, 1, 3, 4)).when(t.rlike(_DIGITS), part(_DIGITS, 1, 2, 3))
    return iso.try_cast("date")


def check_ledger_days(ledger: DataFrame) -> None:
    """Raise :class:`LedgerSchemaError` with the number and the first of the rows whose day is in no known form."""
    text = F.col(LEDGER_DAY_COL)
    bad = ledger.where(text.isNotNull() & ledger_day(text).isNull())
    shown = [r[0] for r in bad.select(LEDGER_DAY_COL).distinct().orderBy(LEDGER_DAY_COL).limit(5).collect()]
    if shown:
        raise LedgerSchemaError(f"{bad.count()} ledger row(s) without a readable day, such as {shown}")


def ledger_days(ledger: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Distinct processed days (``day`` DATE); timestamps are cut to the day, text in no known form raises when read."""
    text = F.col(LEDGER_DAY_COL)
    day = ledger_day(text)
    unread = F.raise_error(F.concat(F.lit("ledger row without a readable day: "), text)).cast("date")
    return ledger.select(*keys, F.when(text.isNull() | day.isNotNull(), day).otherwise(unread).alias("day")).distinct()


def append_ledger(spark: SparkSession, path: str, days: list[str], as_of=None,
                  keys_rows: DataFrame | None = None, keys: tuple[str, ...] = (),
                  checked: bool = False) -> bool:
    """Record ``days`` as processed on ``as_of``; nothing is written for no days.

    No dedupe: a day recorded twice appears twice, as in the reference.
    ``keys_rows`` (keyed ledgers) is a DataFrame of (keys..., day) to record.
    ``checked`` skips the column check when the caller read the ledger already.
    """
    stamp = as_of_string(as_of)
    check_ledger_layout(spark, path)
    header = _header(spark, path) if path_exists(spark, path) else None
    if not checked and header is not None:
        read_ledger(spark, path, keys)  # column check before appending
    order = header or [*keys, *LEDGER_COLUMNS]  # an existing ledger keeps its own column order
    if keys_rows is not None:
        rows = keys_rows.select(*keys, F.col("day").cast("string").alias(LEDGER_DAY_COL),
                                F.lit(stamp).alias(LEDGER_PROCESSED_COL))
        rows.select(*order).write.mode("append").option("header", True).csv(path)
        return True
    if not days:
        return True
    rows = spark.createDataFrame([(d, stamp) for d in days], string_schema(LEDGER_COLUMNS))
    rows.select(*order).coalesce(1).write.mode("append").option("header", True).csv(path)
    return True


def check_ledger_layout(spark: SparkSession, path: str) -> None:
    """A ledger that rows can be appended to is a folder (or not there yet)."""
    if _is_file(spark, path):
        raise LedgerLayoutError(f"{path} is a single-file ledger; copy it into a ledger folder with "
                                "import_ledger() and point the job at the folder")


def _is_file(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.getFileStatus(p).isFile())


def import_ledger(spark: SparkSession, legacy_file: str, path: str) -> int:
    """Copy a single-file CSV ledger (the reference's layout) into the ledger folder ``path``.

    Rows are kept as they are (timestamps included, no dedupe); the column
    check of :func:`read_ledger` applies. Returns the number of rows copied.
    """
    old = read_ledger(spark, legacy_file)
    if old is None:
        return 0
    n = old.count()
    if n:
        old.coalesce(1).write.mode("append").option("header", True).csv(path)
    return n
