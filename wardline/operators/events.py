"""Event building: scans, e-mail checks and described signals in the stored event's shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions import rules


def _event(
    rows: DataFrame,
    event_type: str,
    message: Column,
    event_id: Column | None,
    ts: Column | None,
    country: Column | None = None,
) -> DataFrame:
    absent = F.lit(None).cast("string")
    return rows.select(
        (F.uuid() if event_id is None else event_id.cast("string")).alias("id"),
        F.lit(event_type).alias("event_type"),
        "source",
        "threat_level",
        "threat_score",
        (F.current_timestamp() if ts is None else ts).alias("ts"),
        F.struct(
            message.alias("message"),
            (absent if country is None else country).alias("country"),
            absent.alias("ip"),
        ).alias("payload"),
        F.lit(False).alias("_simulated"),
        F.lit(False).alias("_replay"),
    )


def ip_scan_events(
    reputation: DataFrame, event_id: Column | None = None, ts: Column | None = None
) -> DataFrame:
    """One event per reputation record; a fresh id and the current time unless given."""
    message = rules.ip_event_message(F.col("ip"), F.col("threat_score"))
    return _event(reputation, fv.IP_EVENT_TYPE, message, event_id, ts, F.col("country"))


def email_events(
    checks: DataFrame, event_id: Column | None = None, ts: Column | None = None
) -> DataFrame:
    """One event per e-mail check."""
    message = rules.email_event_message(F.col("email"), F.col("threat_score"))
    return _event(checks, fv.EMAIL_EVENT_TYPE, message, event_id, ts)


def describe_signals(enriched: DataFrame) -> DataFrame:
    """Adds source, message and threat_level to signals that carry their reputation."""
    kind = rules.signal_kind(F.col("category_kind"), F.col("is_tor"), F.col("threat_score"))
    return (
        enriched.withColumn("_kind", kind)
        .withColumn("source", rules.signal_source(F.col("_kind")))
        .withColumn("message", rules.signal_message(F.col("_kind"), F.col("ip")))
        .withColumn("threat_level", rules.score_to_level(F.col("threat_score")))
        .drop("_kind", "category_kind")
    )


def signal_events(described: DataFrame) -> DataFrame:
    """Described signals in the stored event's shape."""
    return described.select(
        F.col("id").cast("string").alias("id"),
        F.lit(fv.IP_EVENT_TYPE).alias("event_type"),
        "source",
        "threat_level",
        "threat_score",
        F.col("ts").cast("timestamp").alias("ts"),
        F.struct("message", "country", "ip").alias("payload"),
        F.lit(True).alias("_simulated"),
        F.lit(False).alias("_replay"),
    )


def flatten_payload(events: DataFrame) -> DataFrame:
    """Stored events as signals: the payload's fields become columns, ready for enrichment."""
    return events.select(*[c for c in events.columns if c != "payload"], "payload.*")
