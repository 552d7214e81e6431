"""Whole answers: what each endpoint of the service gives, as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions.rules import or_default, score_to_level
from wardline.operators import recent, stats
from wardline.operators.scoring import score_records
from wardline.operators.training import ThreatModel
from wardline.operators.trend import trend_aggregates, trend_columns


def anomaly_rate(scored: DataFrame) -> DataFrame:
    """Analysed rows, anomalies, and their share in percent."""
    return scored.agg(*_anomaly_aggregates()).select("total_events_analyzed", "anomaly_count", _rate())


def _anomaly_aggregates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_events_analyzed"),
        F.count_if("anomaly").alias("anomaly_count"),
    ]


def _rate() -> Column:
    rows = F.greatest(F.col("total_events_analyzed"), F.lit(1))
    return F.round(F.col("anomaly_count") / rows * 100, 1).alias("anomaly_rate_pct")


def cluster_breakdown(scored: DataFrame) -> DataFrame:
    return scored.groupBy("cluster_name").agg(F.count(F.lit(1)).alias("n"))


def label_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("rf_prediction").agg(F.count(F.lit(1)).alias("n"))


@dataclass
class BatchReport:
    """Parts of the analytics report. `scored` is cached; call `close` when done."""

    scored: DataFrame
    summary: DataFrame
    clusters: DataFrame
    labels: DataFrame
    sample: DataFrame

    def close(self) -> None:
        self.scored.unpersist()


def score_batch(
    enriched: DataFrame, model: ThreatModel, n: int | None = fv.REPORT_ROWS
) -> DataFrame:
    """The newest `n` enriched signals with their model results."""
    newest = recent.latest(enriched, n)
    country = or_default(F.col("country"), fv.DEFAULT_REPORT_COUNTRY)
    return score_records(newest.withColumn("country", country), model)


def report_summary(scored: DataFrame, least: int = fv.REPORT_MIN_ROWS) -> DataFrame:
    """One row: counts, anomaly rate and trend, all from one aggregate."""
    totals = scored.agg(*_anomaly_aggregates(), *trend_aggregates("ml_adjusted_score"))
    enough = F.col("total_events_analyzed") >= least
    return totals.select(
        F.when(enough, "success").otherwise("not enough events").alias("status"),
        "total_events_analyzed",
        "anomaly_count",
        _rate(),
        *trend_columns(),
    )


def batch_report(
    enriched: DataFrame, model: ThreatModel, n: int | None = fv.REPORT_ROWS
) -> BatchReport:
    """The analytics report over the newest `n` signals (`None`: over all)."""
    scored = score_batch(enriched, model, n).persist()
    level = score_to_level(F.col("threat_score"))
    if "threat_level" in scored.columns:
        level = or_default(F.col("threat_level"), fv.DEFAULT_LEVEL)
    sample = recent.sample_events(scored).select(
        F.col("id").alias("event_id"),
        F.col("threat_score").alias("score"),
        level.alias("level"),
        "ml_adjusted_score",
        "anomaly",
        "cluster_name",
        "rf_prediction",
    )
    return BatchReport(
        scored, report_summary(scored), cluster_breakdown(scored), label_distribution(scored), sample
    )


def dashboard(events: DataFrame) -> dict[str, DataFrame]:
    """The counters the statistics endpoint shows."""
    return {
        "overview": stats.overview(events),
        "levels": stats.level_distribution(events),
        "events_per_minute": stats.last_closed_minute(events),
        "recent": recent.recent_with_timestamp(events),
    }
