"""Counters over the event table; each is one aggregate with map-side combine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions.literals import literal_rows
from wardline.functions.rules import or_default


def overview(events: DataFrame, score: str = "threat_score") -> DataFrame:
    value = or_default(F.col(score), 0)
    average = F.round(F.avg(value), 1)
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias("score_sum"),
        F.coalesce(average, F.lit(0.0)).alias("average_threat_score"),
    )


def level_distribution(events: DataFrame, level: str = "threat_level") -> DataFrame:
    """Events per level. The four known levels are always there; others get their own row."""
    zeros = [(name, 0) for name in fv.LEVELS]
    base = literal_rows(events.sparkSession, "threat_level string, n int", zeros)
    found = events.select(
        or_default(F.col(level), fv.DEFAULT_LEVEL).alias("threat_level"), F.lit(1).alias("n")
    )
    return found.unionByName(base).groupBy("threat_level").agg(F.sum("n").alias("n"))


def level_totals(events: DataFrame, level="threat_level", score="threat_score") -> DataFrame:
    """Count and score sum per level; works on a stream as well."""
    return events.groupBy(or_default(F.col(level), fv.DEFAULT_LEVEL).alias("threat_level")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(or_default(F.col(score), 0)).cast("bigint").alias("score_sum"),
    )


def per_minute(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Events per aligned minute; works on a stream as well."""
    counts = events.groupBy(F.window(ts, "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("minute"), "n")


def last_closed_minute(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Count of the newest minute that is over, zero when there is none.

    A minute is over once an event of a later minute has arrived.
    """
    newest_two = per_minute(events, ts).orderBy(F.desc("minute")).limit(2)
    return newest_two.agg(
        F.when(F.count(F.lit(1)) == 2, F.min_by("n", "minute")).otherwise(0).alias("n")
    )
