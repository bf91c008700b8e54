"""The current table: one row per instrument-day over all reports, the newest report's.

Reports overlap (a ledger gap re-reads later days), each under a name of its
own. The current table is partitioned by day and a report replaces the days it
holds, by dynamic partition overwrite, so an update costs what its report holds
and a repeated update changes nothing. Spark swaps the folders of one update's
days one after the other, so a reader may meet some of them old and some new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybar.session import path_exists

DAY_FOLDER = "report_day"  # the day column itself stays in the files, with its own type


def update_current(report: DataFrame, path: str, day_col: str = "Date") -> None:
    """Replace the report's days in the table at ``path``; days that it does not hold stay."""
    day = F.col(f"`{day_col}`")
    # Day-grain rows; a day's rows go to one task and one file, and AQE joins small days into one task.
    (report.withColumn(DAY_FOLDER, day.cast("string")).repartition(DAY_FOLDER)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY_FOLDER).parquet(path))


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where no report was published yet; filters on ``report_day`` (text) prune folders."""
    if not path_exists(spark, path):
        return None
    fields = [f for f in spark.read.parquet(path).schema if f.name != DAY_FOLDER]
    return spark.read.schema(StructType(fields).add(DAY_FOLDER, "string")).parquet(path)
