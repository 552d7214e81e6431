"""Newest-N views. `n=None` always means the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv


def latest(events: DataFrame, n: int | None, ts: str = "ts", id_column: str = "id") -> DataFrame:
    """The newest `n` rows, newest first (a top-k, no full sort)."""
    if n is None:
        return events
    return events.orderBy(F.desc_nulls_last(ts), F.desc(id_column)).limit(n)


def event_page(events: DataFrame, n: int = fv.PAGE_ROWS) -> DataFrame:
    """Newest-first page with the count of all events beside each row."""
    total = events.agg(F.count(F.lit(1))).scalar()
    return latest(events, n).withColumn("total", total)


def replay(events: DataFrame, n: int = fv.REPLAY_ROWS) -> DataFrame:
    """The newest `n` events in arrival order, marked as a replay."""
    return latest(events, n).orderBy("ts", "id").withColumn("_replay", F.lit(True))


def recent_with_timestamp(events: DataFrame, n: int = fv.VELOCITY_ROWS) -> DataFrame:
    """How many of the newest `n` events carry a timestamp."""
    return latest(events, n).agg(F.count("ts").alias("recent_event_count"))


def sample_events(events: DataFrame, n: int = fv.REPORT_SAMPLE) -> DataFrame:
    return events.orderBy("ts", "id").limit(n)
