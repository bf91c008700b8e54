"""Report sinks: CSV or Parquet, staged, never publishing an empty result."""

from __future__ import annotations

import datetime as _dt
import logging
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from daybar.config import SUPPORTED_FORMATS
from daybar.errors import WrongFormatError
from daybar.session import delete_path, path_exists, rename_path

log = logging.getLogger(__name__)


def check_format(fmt: str) -> str:
    """Only csv and parquet are supported; checked before any work is planned."""
    if fmt not in SUPPORTED_FORMATS:
        log.info("unknown output format: %s", fmt)
        raise WrongFormatError(fmt)
    return fmt


def target_name(prefix: str, fmt: str, now: _dt.datetime | None = None,
                stamp_format: str = "%Y%m%d_%H%M%S") -> str:
    """``{prefix}{now:stamp}.{fmt}``: each run publishes under a new name."""
    now = now or _dt.datetime.now()
    return f"{prefix}{now.strftime(stamp_format)}.{check_format(fmt)}"


def _writer(df: DataFrame, fmt: str):
    w = df.write.mode("errorifexists")
    if fmt == "csv":  # quotes doubled and blanks kept, as other CSV readers expect
        w = (w.option("header", True).option("quote", '"').option("escape", '"')
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    return w.format(fmt)


def publish(df: DataFrame, path: str, fmt: str, *, partitions: int | None = None) -> str | None:
    """Write ``df`` to ``path`` unless it has no rows; return the path or None.

    One pass: the rows are counted by an observation on the write itself, into
    a staging folder beside the target (same file system, hidden name). A
    non-empty result is then renamed into place; an empty one is deleted, so
    no object appears. On file systems with an atomic rename readers never see
    a partial report; on object stores the rename is a copy that they may see
    in part. Other runs' staging folders are never touched, whatever their age.
    Task retries after executor loss are handled by Spark's commit protocol.
    """
    check_format(fmt)
    spark = df.sparkSession
    if path_exists(spark, path):  # rename onto a folder would nest, never overwrite
        raise FileExistsError(path)
    obs = Observation(f"publish_{uuid.uuid4().hex[:8]}")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partitions:
        counted = counted.coalesce(partitions)
    parent, _, leaf = path.rstrip("/").rpartition("/")
    staging = f"{parent}/_staging-{uuid.uuid4().hex[:12]}-{leaf}" if parent else f"_staging-{leaf}"
    _writer(counted, fmt).save(staging)
    rows = int(obs.get.get("rows", 0) or 0)
    if rows == 0:
        delete_path(spark, staging)
        log.info("no rows for %s: nothing published", path)
        return None
    if path_exists(spark, path) or not rename_path(spark, staging, path):
        raise FileExistsError(f"could not publish {staging} to {path}: target exists")
    log.info("Writing %d rows to %s", rows, path)
    return path


def write_csv(df: DataFrame, path: str) -> str | None:
    return publish(df, path, "csv")


def write_parquet(df: DataFrame, path: str) -> str | None:
    return publish(df, path, "parquet")
