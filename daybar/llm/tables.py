"""Reading the given tables and writing intermediate ones in the shared folder."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

import daybar
from daybar.session import delete_path, scratch_path

# Rows of texts handed to a Python worker at once: a few megabytes of usual documents.
ARROW_ROWS = "1000"


def prepare(spark: SparkSession) -> None:
    """Session settings, and this package sent to the Python workers (once a session)."""
    context, name = spark.sparkContext, "daybar_package.zip"
    if name not in context._python_includes:
        top = os.path.dirname(os.path.dirname(os.path.abspath(daybar.__file__)))
        packed = os.path.join(tempfile.mkdtemp(prefix="daybar-send-"), name[:-4])
        context.addPyFile(shutil.make_archive(packed, "zip", top, "daybar"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor costs no lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing needs any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps: it acts when the JVM collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shards_for(amount: int, each: int) -> int:
    """So many groups that each holds about ``each`` of ``amount``."""
    return max(1, -(-int(amount) // each))
