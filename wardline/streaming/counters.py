"""Running counters over a deduplicated stream, kept as sums on shared storage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wardline.operators.stats import level_totals, per_minute
from wardline.sources.store import FOLD, read_sums, sum_writer
from wardline.streaming.ingest import _start

MINUTES = ("minute timestamp, n bigint", ["minute"])
LEVELS = ("threat_level string, n bigint, score_sum bigint", ["threat_level"])


def _start_counter(
    events: DataFrame, count: Callable, keys: list[str], path: str, checkpoint: str, available_now: bool, fold: int
) -> StreamingQuery:
    """Count each batch by itself and add it to the stored sums: no event is ever too late."""
    add = sum_writer(path, keys, fold)

    def write(batch: DataFrame, batch_id: int) -> None:
        add(count(batch), batch_id)

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def start_minute_counts(
    events: DataFrame, path: str, checkpoint: str, ts: str = "ts", available_now: bool = False, fold: int = FOLD
) -> StreamingQuery:
    """Events per aligned minute. A late event is added to its own minute."""
    return _start_counter(events, lambda b: per_minute(b, ts), MINUTES[1], path, checkpoint, available_now, fold)


def start_level_totals(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = False, fold: int = FOLD
) -> StreamingQuery:
    """Count and score sum per level."""
    return _start_counter(events, level_totals, LEVELS[1], path, checkpoint, available_now, fold)


def read_minute_counts(spark: SparkSession, path: str) -> DataFrame:
    return read_sums(spark, path, *MINUTES)


def read_level_totals(spark: SparkSession, path: str) -> DataFrame:
    return read_sums(spark, path, *LEVELS)
