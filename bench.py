"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from wardline.plans import queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))
HEADLINE = (
    "stats_overview", "level_distribution", "events_per_minute", "recent_events", "dedup_signals",
    "first_seen_ip", "ip_report_rollup", "ip_report_categories", "ip_reputation", "email_breaches",
    "geo_enriched", "signal_messages", "signal_features", "scaled_features", "score_trend_all",
    "rf_predictions", "ml_report", "ml_report_recent", "score_clusters", "stream_dedup",
    "stream_minute_counts",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("wardline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> None:
        frame = queries.REGISTRY[name](spark, SF_DIR)
        frame.write.format("noop").mode("overwrite").save()

    run("stats_overview")
    # The fit is timed on its own; scoring queries then use the fitted model.
    seconds = {"model_fit": timed(lambda: queries.model_for(spark, SF_DIR))}
    for name in HEADLINE:
        seconds[name] = min(timed(lambda: run(name)) for _ in range(REPEATS))
    seconds = {name: round(value, 3) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
