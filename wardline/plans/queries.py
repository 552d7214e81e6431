"""Registered queries: each takes (spark, sf_dir) and reads the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions.features import email_features
from wardline.functions.literals import literal_rows
from wardline.functions.rules import adjusted_score, category_name, score_to_level
from wardline.operators import (
    breach,
    clusters,
    day_moments,
    dedup,
    events,
    geo,
    recent,
    reputation,
    scoring,
    stats,
    training,
    trend,
)
from wardline.plans import reports
from wardline.sources import bucketed, day_store, report_days, segments, store, topic
from wardline.sources import testdata as td
from wardline.streaming import counters, ingest, live, state

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}
_models: dict[tuple[str, str], training.ThreatModel] = {}
_days: dict[tuple[str, str], str] = {}
_reputations: dict[tuple[str, str], DataFrame] = {}

# Fixed centres for the distance query, over unscaled features.
FIXED_CENTRES = (
    (0.9, 0.5, 0.5, 1.0, 1.0, 0.6, 1.0, 1.0, 1.0, 1.0, 1.0),
    (0.6, 0.1, 0.1, 0.0, 1.0, 0.3, 1.0, 0.0, 1.0, 0.0, 0.5),
    (0.4, 0.0, 0.0, 0.0, 0.0, 0.2, 0.0, 0.0, 0.0, 1.0, 0.5),
    (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.1),
)
FIXED_LIMIT = 2.0


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# Shared inputs


def requested_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All owners' addresses and the three with a fixed answer."""
    fixed = literal_rows(spark, "ip string", [row[:1] for row in fv.OVERRIDES])
    return td.owners(spark, sf_dir).select("ip").unionByName(fixed)


def reputations(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = td.reputation_payloads(spark, sf_dir)
    return reputation.check_ips(requested_ips(spark, sf_dir), payloads)


def stored_reputations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`reputations` as a stored table, for the life of the session.

    A fit, the rows it scores and a stream look up the same records: the reports behind them are read
    and shuffled once.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _reputations:
        _reputations[key] = store.stage(reputations(spark, sf_dir), "reputation")
    return _reputations[key]


def email_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breach.check_emails(
        td.owners(spark, sf_dir).select("email"),
        td.breach_payloads(spark, sf_dir),
        td.breach_analytics(spark, sf_dir),
    )


def geo_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.geolocate(
        td.owners(spark, sf_dir).select("ip"),
        td.geo_primary(spark, sf_dir),
        td.geo_fallback(spark, sf_dir),
    )


def enriched_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All signals with the reputation of their ip, in a task per `live.TASK_ROWS` of them.

    A model's work on a row is far more than its bytes tell, and the table's row count is in its footers.
    """
    tasks = min(td.events(spark, sf_dir).count() // live.TASK_ROWS, live.MAX_TASKS)
    return reputation.enrich_signals(
        td.signals(spark, sf_dir),
        stored_reputations(spark, sf_dir),
        bounded_by=td.customers(spark, sf_dir),
        probe=td.signal_ips(spark, sf_dir),
        tasks=tasks if tasks > spark.sparkContext.defaultParallelism else 0,
    )


def featured_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_signals(spark, sf_dir).select("id", "threat_score", *fv.FEATURES)


def levelled_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = td.scored_events(spark, sf_dir)
    return scored.withColumn("threat_level", score_to_level(F.col("threat_score")))


def model_for(spark: SparkSession, sf_dir: str) -> training.ThreatModel:
    """The model fitted on all signals of `sf_dir`, kept for the life of the session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        labelled = training.training_set(featured_signals(spark, sf_dir))
        _models[key] = training.fit_model(labelled)
    return _models[key]


def scored_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.score_batch(enriched_signals(spark, sf_dir), model_for(spark, sf_dir), None)


def report_days_of(spark: SparkSession, sf_dir: str) -> str:
    """The session's daily tables of the reports of `sf_dir`."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _days:
        _days[key] = store.shared_dir(spark, "report-days")
    return _days[key]


# Levels, counts, recent events


@query
def signal_levels(spark, sf_dir):
    return levelled_signals(spark, sf_dir).select("id", "threat_score", "threat_level")


@query
def stats_overview(spark, sf_dir):
    return stats.overview(td.scored_events(spark, sf_dir))


@query
def level_distribution(spark, sf_dir):
    return stats.level_distribution(levelled_signals(spark, sf_dir))


@query
def level_totals(spark, sf_dir):
    return stats.level_totals(levelled_signals(spark, sf_dir))


@query
def events_per_minute(spark, sf_dir):
    return stats.per_minute(td.scored_events(spark, sf_dir))


@query
def last_closed_minute(spark, sf_dir):
    return stats.last_closed_minute(td.scored_events(spark, sf_dir))


@query
def recent_events(spark, sf_dir):
    page = recent.event_page(td.scored_events(spark, sf_dir))
    return page.select("id", "ts", "threat_score", "total")


@query
def replay_events(spark, sf_dir):
    replayed = recent.replay(td.scored_events(spark, sf_dir))
    return replayed.select("id", "ts", "threat_score", F.col("_replay").alias("replay"))


@query
def recent_with_timestamp(spark, sf_dir):
    return recent.recent_with_timestamp(td.scored_events(spark, sf_dir))


@query
def sample_events(spark, sf_dir):
    batch = recent.latest(td.scored_events(spark, sf_dir), fv.REPORT_ROWS)
    return recent.sample_events(batch).select("id", "ts", "threat_score")


@query
def dedup_signals(spark, sf_dir):
    """Every event arrives twice."""
    arrived = td.scored_events(spark, sf_dir).select("id", "ts", "threat_score")
    return dedup.dedup_events(arrived.unionByName(arrived))


@query
def dedup_against_store(spark, sf_dir):
    """Every event arrives twice; the even ones are in the store already."""
    arrived = td.scored_events(spark, sf_dir).select("id", "ts", "threat_score")
    stored = bucketed.save_bucketed(bucketed.keyed(arrived.filter("id % 2 = 0")), bucketed.KEY)
    fresh = bucketed.new_events(arrived.unionByName(arrived), stored)
    return spark.table(stored).unionByName(fresh).drop(bucketed.KEY)


@query
def first_seen_ip(spark, sf_dir):
    seen = td.signals(spark, sf_dir).select("ip", "id", "ts", "threat_score")
    return dedup.first_seen(seen)


# Reputation


@query
def ip_report_rollup(spark, sf_dir):
    return reputation.report_rollup(td.reports(spark, sf_dir))


@query
def ip_report_rollup_90d(spark, sf_dir):
    """From the daily tables: of the window's days, those not yet stored are added."""
    newest = td.newest_report_time(spark, sf_dir)
    after, reported = newest - timedelta(days=fv.REPORT_MAX_AGE_DAYS), td.reports(spark, sf_dir)
    days = report_days_of(spark, sf_dir)
    stored = report_days.stored_days(spark, days)
    first = max([after.date(), *stored]) + timedelta(days=1)
    if first <= newest.date():
        report_days.add_days(reported, days, first, newest.date())
    return report_days.rollup_window(spark, days, after, newest.date(), reported)


@query
def ip_categories(spark, sf_dir):
    names = F.array_join("recent_categories", ", ").alias("categories")
    return reputations(spark, sf_dir).select("ip", names)


@query
def ip_report_categories(spark, sf_dir):
    named = reputation.report_categories(td.reports(spark, sf_dir))
    return named.select("ip", F.array_join("recent_categories", ", ").alias("categories"))


@query
def category_counts(spark, sf_dir):
    """Reports per category name."""
    coded = td.reports(spark, sf_dir).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return coded.select("category", category_name(F.col("category")).alias("category_name"), "n")


@query
def ip_reputation(spark, sf_dir):
    return reputations(spark, sf_dir).drop(
        reputation.KEY, "recent_categories", "last_reported"
    )


@query
def signal_messages(spark, sf_dir):
    described = events.describe_signals(enriched_signals(spark, sf_dir))
    return described.select("id", "source", "message")


def _event_columns(built: DataFrame) -> DataFrame:
    return built.select(
        "id", "event_type", "source", "threat_level", "threat_score",
        F.col("payload.message").alias("message"),
    )


@query
def ip_scan_events(spark, sf_dir):
    return _event_columns(events.ip_scan_events(reputations(spark, sf_dir), F.col("ip")))


@query
def email_events(spark, sf_dir):
    return _event_columns(events.email_events(email_checks(spark, sf_dir), F.col("email")))


# Breaches


@query
def email_breaches(spark, sf_dir):
    return email_checks(spark, sf_dir).select(
        "source", "email", "breached", "breach_count", "threat_score", "threat_level",
        F.array_join(F.transform("breaches", lambda b: b["Name"]), ",").alias("breaches"),
        "analytics.passwords", "analytics.credit_cards", "analytics.ssn",
    )


@query
def unbreached_emails(spark, sf_dir):
    return breach.unbreached(td.owners(spark, sf_dir), td.breached_emails(spark, sf_dir))


@query
def unbreached_by_kind(spark, sf_dir):
    """E-mails without a breach that leaked passwords, cards or ids."""
    kinds = list(td.LEAK_KINDS.values())
    return breach.unbreached_by_kind(td.owners(spark, sf_dir), td.leaked_kinds(spark, sf_dir), kinds)


# Geolocation


@query
def geo_enriched(spark, sf_dir):
    return geo_table(spark, sf_dir)


@query
def geo_risk_summary(spark, sf_dir):
    return geo.risk_summary(geo_table(spark, sf_dir))


# Features and fixed model parts


@query
def signal_features(spark, sf_dir):
    return featured_signals(spark, sf_dir).drop("threat_score")


@query
def email_feature_rows(spark, sf_dir):
    return email_checks(spark, sf_dir).select("email", *email_features())


@query
def training_labels(spark, sf_dir):
    return training.label_counts(training.training_set(td.scored_events(spark, sf_dir)))


@query
def class_weights(spark, sf_dir):
    labelled = training.training_set(td.scored_events(spark, sf_dir))
    weighted = training.with_mix_weights(labelled)
    return weighted.groupBy("label_str").agg(F.round(F.sum("weight"), 3).alias("weight_sum"))


@query
def scaled_features(spark, sf_dir):
    staged = store.stage(featured_signals(spark, sf_dir).select("id", *fv.FEATURES), "features")
    scaled = scoring.scale_features(staged)
    return scaled.select(
        "id",
        *[(F.round(F.get("scaled", i), 6) + 0.0).alias(n) for i, n in enumerate(fv.FEATURES)],
    )


@query
def scaled_features_daily(spark, sf_dir):
    """Features scaled by daily moments that were stored in two parts, the later days first."""
    columns = enriched_signals(spark, sf_dir).select("id", "ts", *fv.FEATURES)
    staged = store.stage(columns, "features")
    middle = staged.agg(F.timestamp_seconds((F.unix_seconds(F.min("ts").cast("timestamp")) + F.unix_seconds(F.max("ts").cast("timestamp"))) / 2)).first()[0]
    path = store.shared_dir(spark, "moments")
    write = store.fold_writer(path, lambda rows: rows)
    late = F.coalesce(F.col("ts").cast("timestamp") > F.lit(middle), F.lit(False))
    parts = [day_moments.day_moments(staged.filter(part), list(fv.FEATURES)) for part in (late, ~late)]
    for number, part in enumerate(parts):
        write(part, number)
    merged = day_moments.merge_moments(store.read_parts(spark, path, parts[0].schema))
    scaled = day_moments.scale_by(staged, merged, list(fv.FEATURES), ["id"])
    return scaled.select("id", *[(F.round(n, 6) + 0.0).alias(n) for n in fv.FEATURES])


def fixed_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = [F.col(name) for name in fv.FEATURES]
    nearest = scoring.nearest_centre(vector, FIXED_CENTRES).alias("nearest")
    return enriched_signals(spark, sf_dir).select("id", "ts", "threat_score", nearest)


@query
def fixed_center_anomaly(spark, sf_dir):
    far = F.round("nearest.distance", 6).alias("distance")
    return (
        fixed_nearest(spark, sf_dir)
        .select("id", "nearest.id", far, (F.col("nearest.distance") > FIXED_LIMIT).alias("anomaly"))
        .toDF("id", "centre", "distance", "anomaly")
    )


def fixed_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals scored by the fixed centres and, for labels, by their score bands."""
    label = score_to_level(F.col("threat_score"))
    return fixed_nearest(spark, sf_dir).select(
        "id",
        "ts",
        (F.col("nearest.distance") > FIXED_LIMIT).alias("anomaly"),
        F.concat(F.lit("centre "), F.col("nearest.id")).alias("cluster_name"),
        label.alias("rf_prediction"),
        adjusted_score(F.col("threat_score"), label).alias("ml_adjusted_score"),
    )


@query
def fixed_anomaly_rate(spark, sf_dir):
    return reports.anomaly_rate(fixed_scored(spark, sf_dir))


@query
def fixed_cluster_breakdown(spark, sf_dir):
    return reports.cluster_breakdown(fixed_scored(spark, sf_dir))


@query
def fixed_label_distribution(spark, sf_dir):
    return reports.label_distribution(fixed_scored(spark, sf_dir))


@query
def fixed_report(spark, sf_dir):
    return reports.report_summary(fixed_scored(spark, sf_dir))


@query
def report_of_too_few(spark, sf_dir):
    """The report's answer where the newest events are fewer than it needs."""
    few = recent.latest(fixed_scored(spark, sf_dir), fv.REPORT_MIN_ROWS - 1)
    return reports.report_summary(few).select("status", "total_events_analyzed", "anomaly_count")


@query
def clusters_of_too_few(spark, sf_dir):
    return clusters.split_by_score(td.scored_events(spark, sf_dir), fv.SPLIT_MIN_ROWS - 1)


@query
def adjusted_scores(spark, sf_dir):
    blended = adjusted_score(F.col("threat_score"), F.col("threat_level"))
    return levelled_signals(spark, sf_dir).select("id", blended.alias("ml_adjusted_score"))


@query
def score_trend(spark, sf_dir):
    return trend.score_trend(recent.latest(td.scored_events(spark, sf_dir), fv.TREND_ROWS))


@query
def score_trend_all(spark, sf_dir):
    return trend.score_trend(td.scored_events(spark, sf_dir))


# Fitted models


@query
def rf_predictions(spark, sf_dir):
    scored = scored_signals(spark, sf_dir)
    shares = [F.col("rf_probabilities")[level].alias(f"p_{level}") for level in fv.LEVELS]
    return scored.select("id", "rf_prediction", "rf_confidence", *shares)


@query
def kmeans_clusters(spark, sf_dir):
    scored = scored_signals(spark, sf_dir)
    return scored.select("id", "cluster_id", "cluster_name", "anomaly_score", "anomaly")


@query
def score_clusters(spark, sf_dir):
    return clusters.split_by_score(td.scored_events(spark, sf_dir), None)


@query
def score_clusters_recent(spark, sf_dir):
    return clusters.split_by_score(td.scored_events(spark, sf_dir))


@query
def risk_drivers(spark, sf_dir):
    return scoring.risk_driver_rows(spark, model_for(spark, sf_dir))


@query
def driver_checks(spark, sf_dir):
    """Of the importances: how many, all non-negative, adding to 1; of the drivers in the scored rows:
    how many, weights falling, named like the strongest features, and as many rows as events."""
    model = model_for(spark, sf_dir)
    weights = [weight for _, weight in model.importances]
    drivers = F.col("risk_drivers")
    falling = F.array_sort(drivers["weight"])
    names = F.array(*[F.lit(name) for name, _ in model.importances[: fv.TOP_DRIVERS]])
    return scored_signals(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"),
        *_holds(
            three=F.size(drivers) == fv.TOP_DRIVERS,
            falling=F.reverse(falling) == drivers["weight"],
            strongest=drivers["factor"] == names,
        ),
        F.lit(len(weights)).alias("features"),
        F.lit(all(w >= 0 for w in weights)).alias("positive"),
        F.lit(abs(sum(weights) - 1) < 1e-6).alias("whole"),
    )


@query
def email_scores(spark, sf_dir):
    scored = scoring.score_records(email_checks(spark, sf_dir), model_for(spark, sf_dir), "email")
    return scored.select(
        "email", "threat_score", "rf_prediction", "cluster_name", "anomaly", "ml_adjusted_score"
    )


@query
def ip_scores(spark, sf_dir):
    """Reputation checks with their model results, the ip endpoint's full answer."""
    scored = scoring.score_records(reputations(spark, sf_dir), model_for(spark, sf_dir))
    return scored.select(
        "ip", "threat_score", "threat_level", "rf_prediction", "rf_confidence", "cluster_name",
        "anomaly", "anomaly_score", "ml_adjusted_score",
    )


@query
def ml_report(spark, sf_dir):
    return reports.report_summary(scored_signals(spark, sf_dir))


def recent_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest signals of a report with their reputation: cut first, then looked up.

    The reputations are those of the cut signals' addresses.
    """
    newest = recent.latest(td.signals(spark, sf_dir), fv.REPORT_ROWS)
    payloads = td.reputation_payloads(spark, sf_dir, newest)
    known = reputation.check_ips(newest.select("ip"), payloads)
    return reputation.enrich_signals(newest, known, bounded_by=newest)


@query
def ml_report_recent(spark, sf_dir):
    model = model_for(spark, sf_dir)
    return reports.report_summary(reports.score_batch(recent_enriched(spark, sf_dir), model, None))


@query
def cluster_breakdown(spark, sf_dir):
    return reports.cluster_breakdown(scored_signals(spark, sf_dir))


@query
def rf_distribution(spark, sf_dir):
    return reports.label_distribution(scored_signals(spark, sf_dir))


@query
def anomaly_rate(spark, sf_dir):
    return reports.anomaly_rate(scored_signals(spark, sf_dir))


# Properties of the fitted models that hold whatever the fit gives, counted over all rows


def _holds(**tests) -> list:
    return [F.count_if(test).alias(name) for name, test in tests.items()]


@query
def rf_checks(spark, sf_dir):
    """Rows, and how many have a known label, shares of 100 %, their maximum as confidence, and the
    score blended by the predicted label."""
    shares = F.map_values("rf_probabilities")
    total = F.aggregate(shares, F.lit(0.0), lambda a, b: a + b)
    blended = adjusted_score(F.col("threat_score"), F.col("rf_prediction"))
    return scored_signals(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"),
        *_holds(
            labelled=F.col("rf_prediction").isin(*fv.LEVELS),
            whole=F.abs(total - 100) < 0.3,
            confident=F.array_max(shares) == F.col("rf_confidence"),
            blended=blended == F.col("ml_adjusted_score"),
        ),
    )


@query
def kmeans_checks(spark, sf_dir):
    """Rows, and how many are with their nearest centre, named by it, and far exactly if anomalous."""
    model = model_for(spark, sf_dir)
    scored = scoring.score_records(featured_signals(spark, sf_dir), model).select(
        "id", "cluster_id", "cluster_name", "anomaly", "anomaly_score"
    )
    scaled = model.scaler.transform(training.assembler().transform(featured_signals(spark, sf_dir)))
    vector = vector_to_array("features").alias("_scaled")
    near = scoring.nearest_centre(scoring.elements("_scaled"), model.centres)
    joined = scored.join(scaled.select("id", vector).select("id", near.alias("near")), "id")
    return joined.agg(
        F.count(F.lit(1)).alias("n"),
        *_holds(
            nearest=F.abs(F.col("near.distance") - F.col("anomaly_score")) < 1e-4,
            named=F.col("cluster_name").isin(*model.cluster_names.values()),
            far=F.col("anomaly") == (F.col("near.distance") > fv.ANOMALY_DISTANCE),
        ),
    )


@query
def split_checks(spark, sf_dir):
    """The score split has two parts, a threshold between them, and every event in one."""
    split = clusters.split_by_score(td.scored_events(spark, sf_dir), None)
    low, high = (F.when(F.col("cluster") == c, F.col("score")) for c in (0, 1))
    return split.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("cluster").alias("parts"),
        (F.max(low) < F.min(high)).alias("apart"),
    )


def _record_checks(scored: DataFrame) -> DataFrame:
    blended = adjusted_score(F.col("threat_score"), F.col("rf_prediction"))
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        *_holds(
            labelled=F.col("rf_prediction").isin(*fv.LEVELS),
            blended=blended == F.col("ml_adjusted_score"),
        ),
    )


@query
def email_score_checks(spark, sf_dir):
    return _record_checks(email_scores(spark, sf_dir))


@query
def ip_score_checks(spark, sf_dir):
    return _record_checks(ip_scores(spark, sf_dir))


@query
def report_checks(spark, sf_dir):
    """Events behind the fitted report, its clusters and its labels."""
    scored = scored_signals(spark, sf_dir)
    return reports.report_summary(scored).select(
        "status",
        "total_events_analyzed",
        reports.cluster_breakdown(scored).agg(F.sum("n")).scalar().alias("in_clusters"),
        reports.label_distribution(scored).agg(F.sum("n")).scalar().alias("in_labels"),
    )


# Streams over the same tables, run to the end of the input


ARRIVALS = 6
# Rows of a file that arrives: a reader's task takes at least one file.
ARRIVAL_ROWS = 100_000


def arrivals(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """The event table as files that arrive in the wrong order, newest events first.

    Its folder, and how many files make up an arrival.
    """
    path, table = store.shared_dir(spark, "arrivals"), td.events(spark, sf_dir)
    first, last = table.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / ARRIVALS
    bounds = [first + step * i for i in range(1, ARRIVALS)]
    for i in reversed(range(ARRIVALS)):
        # Events without a time come with the last arrival.
        late = F.coalesce(F.col("ts") >= F.lit(bounds[i - 1]), F.lit(False)) if i else F.lit(True)
        early = F.coalesce(F.col("ts") < F.lit(bounds[i]), F.lit(i == 0)) if i < ARRIVALS - 1 else F.lit(True)
        table.filter(late & early).write.mode("append").option("maxRecordsPerFile", ARRIVAL_ROWS).parquet(path)
    files = len(spark.read.schema(table.schema).parquet(path).inputFiles())
    return path, max(1, files // ARRIVALS)


def event_stream(spark: SparkSession, sf_dir: str, arrived: tuple[str, int] | None = None) -> DataFrame:
    """The event table as a stream of signals with a level, in many batches."""
    path, files = arrived or arrivals(spark, sf_dir)
    schema = td.events(spark, sf_dir).schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    level = score_to_level(F.col("threat_score"))
    return (
        td.with_address(raw)
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .withColumn("threat_level", level)
    )


def _paths(spark: SparkSession, name: str) -> tuple[str, str]:
    base = store.shared_dir(spark, name)
    return f"{base}/data", f"{base}/checkpoint"


def _deduplicated(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Ingest every event twice into a new store; its path and schema."""
    files = arrivals(spark, sf_dir)
    arrived = event_stream(spark, sf_dir, files)
    path, checkpoint = _paths(spark, "ingest")
    ingest.start_ingest(
        arrived.unionByName(event_stream(spark, sf_dir, files)), path, checkpoint, available_now=True
    ).awaitTermination()
    return path, arrived.schema


@query
def stream_dedup(spark, sf_dir):
    path, schema = _deduplicated(spark, sf_dir)
    stored = ingest.read_store(spark, path, schema)
    return stored.select("id", F.col("ts").cast("timestamp_ntz").alias("ts"), "threat_score")


@query
def stream_minute_counts(spark, sf_dir):
    path, schema = _deduplicated(spark, sf_dir)
    out, checkpoint = _paths(spark, "minutes")
    stored = ingest.stream_store(spark, path, schema)
    counters.start_minute_counts(stored, out, checkpoint, available_now=True).awaitTermination()
    counts = counters.read_minute_counts(spark, out)
    return counts.select(F.col("minute").cast("timestamp_ntz").alias("minute"), "n")


@query
def stream_level_counts(spark, sf_dir):
    path, schema = _deduplicated(spark, sf_dir)
    out, checkpoint = _paths(spark, "levels")
    stored = ingest.stream_store(spark, path, schema)
    counters.start_level_totals(stored, out, checkpoint, available_now=True).awaitTermination()
    return counters.read_level_totals(spark, out)


@query
def stream_first_seen(spark, sf_dir):
    """First observation of each ip, kept as state over the disordered arrivals."""
    seen = event_stream(spark, sf_dir).select("ip", "id", "ts", "threat_score")
    path, checkpoint = _paths(spark, "first-seen")
    state.start_first_seen(seen, path, checkpoint, available_now=True).awaitTermination()
    first = state.read_first_seen(spark, path, seen.schema)
    return first.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_day_store(spark, sf_dir):
    """The newest page from the store by day, into which every arrival was written twice."""
    arrived = event_stream(spark, sf_dir).select("id", "ts", "threat_score")
    path, checkpoint = _paths(spark, "days")
    once = day_store.day_store_writer(path)

    def twice(batch: DataFrame, batch_id: int) -> None:
        once(batch, batch_id)
        once(batch, batch_id)

    writer = arrived.writeStream.foreachBatch(twice).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    page = day_store.newest(spark, path, arrived.schema, fv.PAGE_ROWS)
    total = F.lit(day_store.stored_count(spark, path)).alias("total")
    return page.select("id", F.col("ts").cast("timestamp_ntz").alias("ts"), "threat_score", total)


@query
def stream_segments(spark, sf_dir):
    """Every event as a message of a stored topic, in two segments, read back by the stream source."""
    path, checkpoint = _paths(spark, "segments")
    level = score_to_level(F.col("threat_score"))
    shown = td.signals(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).withColumn("threat_level", level)
    shown = shown.select(F.col("id").cast("string"), "ts", "threat_score", "threat_level")
    for part in ("id % 2 = 0", "id % 2 = 1"):
        segments.append_messages(topic.encode_signals(shown.filter(part)), f"{path}-topic")
    stream = topic.decode_signals(segments.read_segments(spark, f"{path}-topic", "earliest"))
    ingest.start_store(stream, path, checkpoint, available_now=True).awaitTermination()
    back = ingest.read_store(spark, path, stream.schema)
    return back.select(
        F.col("id").cast("bigint"), F.col("ts").cast("timestamp_ntz").alias("ts"), "threat_score", "threat_level"
    )


def _scored_store(spark: SparkSession, sf_dir: str):
    model = model_for(spark, sf_dir)
    known = stored_reputations(spark, sf_dir)
    path, checkpoint = _paths(spark, "scored")
    live.start_scoring(
        event_stream(spark, sf_dir), known, model, path, checkpoint, td.customers(spark, sf_dir),
        available_now=True, known=f"{path}-known",
    ).awaitTermination()
    sample = live.score_signals(
        td.signals(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")), known, model
    )
    return store.read_batches(spark, path, sample.schema).drop("batch_id")


@query
def stream_push(spark, sf_dir):
    """Every event as a line of text, read back."""
    path, checkpoint = _paths(spark, "push")
    pushed = event_stream(spark, sf_dir).select(F.col("id").cast("string"), "ts", "threat_score", "threat_level")
    ingest.start_push(pushed, path, checkpoint, available_now=True).awaitTermination()
    back = topic.decode_signals(spark.read.schema("value string").text(path))
    return back.select(
        F.col("id").cast("bigint"), F.col("ts").cast("timestamp_ntz").alias("ts"), "threat_score", "threat_level"
    )


@query
def stream_score_checks(spark, sf_dir):
    return _record_checks(_scored_store(spark, sf_dir))


@query
def stream_scored(spark, sf_dir):
    scored = _scored_store(spark, sf_dir)
    return scored.select("id", "source", "rf_prediction", "cluster_name", "ml_adjusted_score")


@query
def stream_trend(spark, sf_dir):
    """The trend as it stands after the last of the disordered arrivals."""
    arrived = event_stream(spark, sf_dir)
    scored = arrived.withColumn("ml_adjusted_score", adjusted_score(F.col("threat_score"), F.col("threat_level")))
    path, checkpoint = _paths(spark, "trend")
    live.start_trend(scored, f"{path}-history", path, checkpoint, available_now=True).awaitTermination()
    return live.last_trend(spark, path)


@query
def stream_trend_model(spark, sf_dir):
    return live.history_trend(_scored_store(spark, sf_dir))
