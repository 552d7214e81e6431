"""Daily tables of report sets, from which a moving window is rolled up."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.report_sets import merge_words, report_words, rollup_words
from wardline.sources.store import folder_names

# Files of a day, at most.
FILES = 8


def of_days(reports: DataFrame, first: date, last: date) -> DataFrame:
    """The reports of some days: a range of times, which a scan or its partitions can be cut by."""
    ends = F.lit(first), F.lit(last + timedelta(days=1))
    return reports.filter((F.col("reported_at") >= ends[0]) & (F.col("reported_at") < ends[1]))


def add_days(reports: DataFrame, path: str, first: date, last: date) -> None:
    """Stores the sets of the days from `first` to `last`, one folder per day.

    Only these days' reports are read. A day that was stored before is replaced, so a call may be
    repeated; readers see a day when its files are complete. A day without reports leaves no folder.
    """
    day = F.col("reported_at").cast("date").alias("day")
    words = report_words(of_days(reports, first, last).select("*", day), "day")
    # Rows of a day are spread by ip, so a busy day is written by several tasks.
    spread = words.repartition("day", F.pmod(F.xxhash64("ip"), F.lit(FILES)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """Days with a folder, ascending; no file is read."""
    names = [n.removeprefix("day=") for n in folder_names(spark, path) if n.startswith("day=")]
    return sorted(date.fromisoformat(n) for n in names)


def read_days(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """Sets of the stored days from `first` to `last`; other days' folders are not read."""
    return spark.read.parquet(path).filter(F.col("day").between(F.lit(first), F.lit(last)))


def rollup_window(spark: SparkSession, path: str, after: datetime, last: date, edge: DataFrame | None = None) -> DataFrame:
    """Rollup of the reports later than `after`, up to the day `last`, from the daily tables.

    The day of `after` is only partly in the window: its reports are taken from `edge` (the reports
    themselves, of which that day is read), where it is given. Reports dated by day need no edge.
    """
    words = read_days(spark, path, after.date() + timedelta(days=1), last).drop("day")
    if edge is not None:
        partly = of_days(edge, after.date(), after.date()).filter(F.col("reported_at") > F.lit(after))
        words = words.unionByName(report_words(partly))
    return rollup_words(merge_words(words))
