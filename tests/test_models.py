import json

import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.operators import clusters, events, reputation, scoring, training
from wardline.plans import queries, reports
from wardline.sources import store, topic


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return queries.model_for(spark, sf_dir)


@pytest.fixture(scope="module")
def enriched(spark, sf_dir):
    return store.stage(queries.enriched_signals(spark, sf_dir), "enriched")


@pytest.fixture(scope="module")
def scored(enriched, model):
    return scoring.score_records(enriched, model).persist()


def test_forest_results_hold_together(scored):
    top = F.array_max(F.map_values("rf_probabilities"))
    total = F.aggregate(F.map_values("rf_probabilities"), F.lit(0.0), lambda a, p: a + p)
    bad = scored.filter(
        ~F.col("rf_prediction").isin(*fv.LEVELS)
        | (F.col("rf_confidence") != top)
        | (F.col("rf_probabilities")[F.col("rf_prediction")] != top)
        | (F.abs(total - 100) > 0.3)
    )
    assert bad.count() == 0


def test_assigned_centre_is_the_nearest(enriched, scored, model):
    assembled = scoring.add_features(enriched)
    vectors = training.assembler().transform(assembled)
    scaled = model.scaler.transform(vectors).withColumn("v", vector_to_array("features"))
    nearest = scoring.nearest_centre(scoring.elements("v"), model.centres)
    expected = scaled.select("id", F.round(nearest["distance"], 4).alias("d"), nearest["id"].alias("c"))
    joined = scored.join(expected, "id")
    assert joined.filter("abs(d - anomaly_score) > 1e-4").count() == 0
    assert joined.filter("c <> cluster_id").count() == 0
    assert scored.filter("anomaly <> (anomaly_score > 3.5)").count() == 0


def test_names_follow_the_centres_score(model):
    ranked = sorted(range(len(model.centres)), key=lambda i: -model.centres[i][0])
    assert [model.cluster_names[i] for i in ranked] == list(fv.CLUSTER_NAMES)
    by_id = training.ThreatModel(model.pipeline, "by_id")
    assert by_id.cluster_names == dict(enumerate(fv.CLUSTER_NAMES))


def test_drivers_and_adjusted_score(spark, scored, model):
    drivers = scored.select("risk_drivers").first()[0]
    assert len(drivers) == fv.TOP_DRIVERS and drivers[0]["weight"] >= drivers[1]["weight"]
    table = scoring.risk_driver_rows(spark, model).orderBy("rank").collect()
    assert [(r["factor"], r["weight"]) for r in table] == [tuple(d) for d in drivers]
    weights = {"critical": 100, "high": 70, "medium": 45, "low": 10}
    for score, label, adjusted in scored.select(
        "threat_score", "rf_prediction", "ml_adjusted_score"
    ).collect():
        assert adjusted == int(0.6 * score + 0.4 * weights[label])


def test_scoring_does_not_depend_on_partitions(enriched, model):
    columns = ("id", "rf_prediction", "rf_confidence", "cluster_id", "anomaly_score")
    one = scoring.score_records(enriched.coalesce(1), model)
    many = scoring.score_records(enriched.repartition(8), model)
    assert rows(one, *columns) == rows(many, *columns)


def test_fit_does_not_depend_on_partitions(enriched, model):
    features = scoring.add_features(enriched).select("id", "threat_score", *fv.FEATURES)
    again = training.fit_model(training.training_set(features.repartition(7)))
    columns = ("id", "rf_prediction", "rf_confidence", "cluster_id")
    first = scoring.score_records(enriched, model)
    assert rows(scoring.score_records(enriched, again), *columns) == rows(first, *columns)


def test_saved_model_scores_the_same(spark, enriched, model, tmp_path):
    model.save(str(tmp_path / "model"))
    loaded = training.ThreatModel.load(spark, str(tmp_path / "model"))
    columns = ("id", "rf_prediction", "cluster_name", "anomaly_score", "ml_adjusted_score")
    a = scoring.score_records(enriched, model)
    assert rows(scoring.score_records(enriched, loaded), *columns) == rows(a, *columns)


def test_email_records_are_scored_by_the_same_model(spark, sf_dir, model):
    checks = queries.email_checks(spark, sf_dir)
    out = scoring.score_records(checks, model, "email")
    assert out.count() == checks.count()
    assert out.filter(~F.col("rf_prediction").isin(*fv.LEVELS)).count() == 0


def many_rows(spark):
    """50,000 rows, four of five with a low score; the features tell nothing of it."""
    score = F.when(F.col("id") % 50 < 10, 70).otherwise(10).alias("threat_score")
    vector = [((F.col("id") % 10) / 10 * (i + 1)).alias(name) for i, name in enumerate(fv.FEATURES)]
    return spark.range(50_000).select("id", score, *vector)


def shares_of_low(model, features):
    index = model.labels.index("low")
    found = model.pipeline.transform(features.select(*fv.FEATURES).distinct())
    return [r[0] for r in found.select(vector_to_array("rf_probability")[index]).collect()]


def test_the_forest_is_trained_on_all_rows(spark):
    """No label is thinned out: the leaves have the labels' shares among all rows."""
    features = many_rows(spark)
    model = training.fit_model(training.training_set(features))
    shares = shares_of_low(model, features)
    assert len(shares) == 10 and shares == pytest.approx([0.8] * 10, abs=0.03)


def test_the_model_of_the_queries_is_fitted_on_all_signals(spark, monkeypatch):
    features = many_rows(spark)
    monkeypatch.setattr(queries, "featured_signals", lambda spark, sf_dir: features)
    monkeypatch.setattr(queries, "_models", {})
    model = queries.model_for(spark, "many")
    assert shares_of_low(model, features) == pytest.approx([0.8] * 10, abs=0.03)


@pytest.fixture(scope="module")
def many_events(spark, tmp_path_factory):
    """Tables with 25,000 events, 20,000 of them with a low score."""
    path = str(tmp_path_factory.mktemp("many"))
    row, day = F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz")
    tables = {
        "customer": (20, [row.alias("c_custkey"), (row % 25).cast("int").alias("c_nationkey")]),
        "orders": (40, [row.alias("o_orderkey"), (row % 20).alias("o_custkey"), day.alias("o_orderdate")]),
        "lineitem": (80, [(row % 40).alias("l_orderkey"), row.alias("l_partkey"), (row % 7).alias("l_suppkey")]),
        "events": (25_000, [
            row.alias("event_id"), (day + F.make_dt_interval(secs=row)).alias("ts"), (row % 20).alias("user_id"),
            F.lit("view").alias("event_type"), F.when(row % 5 == 0, 70.0).otherwise(10.0).alias("value"),
        ]),
    }
    for name, (n, columns) in tables.items():
        spark.range(n).select(*columns).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", ["stream_scored", "stream_trend_model"])
def test_streams_are_scored_by_a_forest_of_all_events(spark, many_events, monkeypatch, name):
    seen, fit = [], training.RandomForestClassifier.fit

    def counted(self, rows):
        seen.append(rows.count())
        return fit(self, rows)

    monkeypatch.setattr(queries, "_models", {})
    monkeypatch.setattr(training.RandomForestClassifier, "fit", counted)
    out = queries.REGISTRY[name](spark, many_events)
    assert out.count() == (25_000 if name == "stream_scored" else 1)
    assert seen == [25_000]


def test_class_weights_give_the_mix(spark):
    labels = ["critical"] * 5 + ["high"] * 10 + ["medium"] * 20 + ["low"] * 65
    labelled = spark.createDataFrame([(label,) for label in labels], "label_str string")
    sums = training.with_mix_weights(labelled).groupBy("label_str").agg(F.sum("weight"))
    assert dict(rows(sums)) == pytest.approx({"critical": 15, "high": 25, "medium": 30, "low": 30})


def test_weighted_fit(enriched):
    features = scoring.add_features(enriched).select("id", "threat_score", *fv.FEATURES)
    weighted = training.with_mix_weights(training.training_set(features))
    model = training.fit_model(weighted, weight="weight")
    assert sorted(model.labels) == sorted(fv.LEVELS)


def test_split_is_a_threshold_between_the_centres(spark, sf_dir):
    split = queries.score_clusters(spark, sf_dir)
    ranges = split.groupBy("cluster").agg(F.min("score"), F.max("score"), F.avg("score")).collect()
    low, high = sorted(ranges, key=lambda r: r[3])
    assert low[2] < high[1]
    middle = (low[3] + high[3]) / 2
    assert low[2] <= middle <= high[1]
    assert split.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_split_needs_five_events(spark):
    few = spark.createDataFrame([(i, None, i * 10) for i in range(5)], "id int, ts timestamp, threat_score int")
    assert clusters.split_by_score(few.limit(4)).count() == 0
    assert clusters.split_by_score(few).count() == 5
    assert clusters.split_by_score(few).columns == ["cluster", "id", "score"]


def test_batch_report(enriched, model):
    report = reports.batch_report(enriched, model, 50)
    summary = report.summary.first()
    assert summary["status"] == "success" and summary["total_events_analyzed"] == 50
    assert summary["data_points"] == 50
    assert sum(n for _, n in rows(report.clusters)) == 50
    assert sum(n for _, n in rows(report.labels)) == 50
    anomalies = report.scored.filter("anomaly").count()
    assert summary["anomaly_count"] == anomalies
    assert summary["anomaly_rate_pct"] == pytest.approx(anomalies * 2, abs=0.1)
    sample = report.sample.collect()
    assert len(sample) == fv.REPORT_SAMPLE
    assert set(sample[0].asDict()) == {
        "event_id", "score", "level", "ml_adjusted_score", "anomaly", "cluster_name", "rf_prediction",
    }
    report.close()
    few = reports.report_summary(reports.score_batch(enriched, model, 2)).first()
    assert few["status"] == "not enough events" and few["trend"] == "stable"


def test_report_over_stored_events(spark, model):
    """The way from wire text to the report, with levels as the events state them."""
    lines = [
        json.dumps(
            {
                "id": f"e{i}", "threat_level": "high", "threat_score": 10 * i,
                "timestamp": f"2024-01-01T00:{i:02d}:00+00:00", "payload": {"ip": "9.9.9.9"},
            }
        )
        for i in range(6)
    ]
    texts = spark.createDataFrame([(line,) for line in lines], "value string")
    signals = events.flatten_payload(topic.decode_signals(texts))
    nothing = spark.createDataFrame([], "ip string, payload string")
    known = reputation.check_ips(signals, nothing)
    report = reports.batch_report(reputation.enrich_signals(signals, known), model)
    sample = report.sample.orderBy("event_id").collect()
    assert [r["event_id"] for r in sample] == ["e0", "e1", "e2", "e3", "e4"]
    assert {r["level"] for r in sample} == {"high"}
    assert report.summary.first()["total_events_analyzed"] == 6
    report.close()


def test_scaling_of_a_constant_column_is_zero(spark):
    df = spark.range(4).select("id", *[F.lit(0.5).alias(f) for f in fv.FEATURES[:-1]],
                               F.col("id").cast("double").alias(fv.FEATURES[-1]))
    out = [r["scaled"] for r in scoring.scale_features(df).orderBy("id").collect()]
    assert all(v == 0.0 for vector in out for v in vector[:-1])
    assert [round(v[-1], 6) for v in out] == [-1.161895, -0.387298, 0.387298, 1.161895]


def test_fits_and_scores_look_up_one_stored_table_of_reputations(spark, sf_dir):
    read = queries.enriched_signals(spark, sf_dir).inputFiles()
    assert not any("lineitem" in file or "orders" in file for file in read)
    assert rows(queries.stored_reputations(spark, sf_dir).drop("last_reported")) == rows(
        queries.reputations(spark, sf_dir).drop("last_reported")
    )
