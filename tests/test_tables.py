from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.operators import dedup, joins, recent, stats, trend
from wardline.plans import reports

T0 = datetime(2024, 1, 1)


def events(spark, items):
    return spark.createDataFrame(
        items, "id string, ts timestamp, threat_score int, threat_level string"
    )


def at(minutes=0, seconds=0.0):
    return T0 + timedelta(minutes=minutes, seconds=seconds)


def test_dedup_keeps_different_rows_without_id(spark):
    df = events(
        spark,
        [
            ("a", at(1), 1, "low"),
            ("a", at(0), 2, "low"),
            ("a", None, 3, "low"),
            (None, at(0), 1, "low"),
            (None, at(0), 1, "low"),
            (None, at(0), 2, "low"),
        ],
    )
    out = dedup.dedup_events(df)
    assert rows(out, "id", "threat_score") == [("a", 2), (None, 1), (None, 2)]
    assert out.columns == df.columns


def test_first_seen_breaks_ties_by_id(spark):
    df = spark.createDataFrame(
        [("x", 2, at(0), 5), ("x", 1, at(0), 6), ("x", 0, at(1), 7), (None, 9, at(0), 8)],
        "ip string, id bigint, ts timestamp, threat_score int",
    )
    assert rows(dedup.first_seen(df)) == [("x", 1, at(0), 6)]


def test_counters(spark):
    df = events(
        spark,
        [("a", at(0), 10, "low"), ("b", at(0), 15, None), ("c", at(1), None, "weird"), ("d", None, 90, "critical")],
    )
    assert rows(stats.overview(df)) == [(4, 115, 28.8)]
    assert dict(rows(stats.level_distribution(df))) == {
        "critical": 1, "high": 0, "medium": 0, "low": 2, "weird": 1,
    }
    assert ("low", 2, 25) in rows(stats.level_totals(df))
    empty = df.limit(0)
    assert rows(stats.overview(empty)) == [(0, 0, 0.0)]
    assert dict(rows(stats.level_distribution(empty))) == dict.fromkeys(fv.LEVELS, 0)


def test_minutes_are_aligned(spark):
    df = events(
        spark,
        [("a", at(0, 59.999), 1, "low"), ("b", at(1), 1, "low"), ("c", at(1, 30), 1, "low"), ("d", at(5), 1, "low")],
    )
    assert rows(stats.per_minute(df)) == [(at(0), 1), (at(1), 2), (at(5), 1)]
    assert rows(stats.last_closed_minute(df)) == [(2,)]
    assert rows(stats.last_closed_minute(df.limit(1))) == [(0,)]


def test_dashboard(spark):
    df = events(spark, [(f"e{i}", at(i // 4), 90 if i else 0, "high") for i in range(9)])
    board = reports.dashboard(df)
    assert rows(board["overview"]) == [(9, 720, 80.0)]
    assert dict(rows(board["levels"]))["high"] == 9
    assert rows(board["events_per_minute"]) == [(4,)]
    assert rows(board["recent"]) == [(9,)]


def test_recent_views(spark):
    df = events(spark, [(f"e{i:02d}", at(i // 2), i, "low") for i in range(30)] + [("z", None, 0, "low")])
    page = recent.event_page(df, 3).collect()
    assert [(r["id"], r["total"]) for r in page] == [("e29", 31), ("e28", 31), ("e27", 31)]
    assert recent.latest(df, 0).count() == 0 and recent.latest(df, None).count() == 31
    replayed = recent.replay(df, 2).collect()
    assert [(r["id"], r["_replay"]) for r in replayed] == [("e28", True), ("e29", True)]
    assert rows(recent.recent_with_timestamp(df)) == [(30,)]
    assert [r["id"] for r in recent.sample_events(df.filter("ts is not null"), 2).collect()] == ["e00", "e01"]


@pytest.mark.parametrize(
    ("slope", "start", "hours", "word", "following"),
    [
        (5, 20, 12, "rising", 80.0),
        (-3, 80, 12, "falling", 44.0),
        (2, 20, 12, "stable", 44.0),
        (5, 90, 12, "rising", 100.0),
        (-9, 80, 12, "falling", 0.0),
    ],
)
def test_trend(spark, slope, start, hours, word, following):
    df = spark.createDataFrame(
        [(T0 + timedelta(hours=h), float(start + slope * h)) for h in range(hours)],
        "ts timestamp, threat_score double",
    )
    assert rows(trend.score_trend(df)) == [(float(slope), float(start), following, word, hours)]


def test_trend_edges(spark):
    schema = "ts timestamp, threat_score int"
    same = spark.createDataFrame([(T0, s) for s in range(10)], schema)
    assert rows(trend.score_trend(same)) == [(0.0, 4.5, 4.5, "stable", 10)]
    few = spark.createDataFrame([(at(i), i) for i in range(9)], schema)
    assert rows(trend.score_trend(few)) == [(0.0, 0.0, None, "stable", 9)]
    assert rows(trend.score_trend(few.limit(0))) == [(0.0, 0.0, None, "stable", 0)]
    line = spark.createDataFrame([(T0 + timedelta(hours=h), h) for h in range(20)], schema)
    later = F.lit(T0 + timedelta(hours=29))
    assert rows(trend.score_trend(line, asof=later))[0][2] == 30.0


def test_trend_matches_mllib(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from wardline.sources import testdata as td

    df = td.scored_events(spark, sf_dir)
    first = df.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0]
    hours = (F.unix_micros(F.col("ts").cast("timestamp")) - first) / 3.6e9
    points = df.select(hours.alias("h"), F.col("threat_score").cast("double").alias("y"))
    vectors = VectorAssembler(inputCols=["h"], outputCol="features").transform(points)
    fitted = LinearRegression(featuresCol="features", labelCol="y").fit(vectors)
    slope, intercept, *_ = rows(trend.score_trend(df))[0]
    assert slope == pytest.approx(fitted.coefficients[0], abs=6e-4)
    assert intercept == pytest.approx(fitted.intercept, abs=6e-3)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("key_type", ["string", "bigint"])
def test_salted_lookup_equals_a_plain_join(spark, how, key_type):
    # One key holds a third of the rows, another third has none, two keys are unknown.
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50)
    fact = spark.range(3000).select("id", key.cast(key_type).alias("k"), F.lit("same").alias("v"))
    dim = spark.range(2, 49).select(F.col("id").cast(key_type).alias("k"), (F.col("id") * 2).alias("d"))
    hot = joins.hot_keys(fact, "k", hot_rows=100, fraction=1.0)
    assert [(str(k), salts) for k, salts in hot] == [("7", 12)]
    salted = joins.salted_lookup(fact, dim, "k", how, hot)
    assert rows(joins.salted_lookup(fact, dim, "k", how, []), "id", "k", "v", "d") == rows(
        fact.join(dim, "k", how), "id", "k", "v", "d"
    )
    assert rows(salted, "id", "k", "v", "d") == rows(fact.join(dim, "k", how), "id", "k", "v", "d")


def test_a_plain_join_has_more_tasks_on_more_rows(spark, monkeypatch):
    fact = spark.range(0, 4000, 1, 8).select("id", (F.col("id") % 50).alias("k"))
    fact = fact.withColumn("k", F.when(F.col("id") % 9 > 0, F.col("k")))
    dim = spark.range(40).select(F.col("id").alias("k"), F.lit(1).alias("d"))
    monkeypatch.setattr(joins, "TASK_BYTES", joins.estimated_bytes(fact) // 40)
    for times in (1, 2):
        monkeypatch.setattr(joins, "TASK_BYTES", joins.TASK_BYTES // times)
        joined = joins.salted_lookup(fact, dim.hint("merge"), "k", "inner", [])
        assert joined.rdd.getNumPartitions() >= 40 * times
        assert rows(joined, "id", "k", "d") == rows(fact.join(dim, "k"), "id", "k", "d")


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_scored_facts_go_to_as_many_tasks_as_asked(spark, limit):
    """A few bytes in one task may be hours of scoring."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        fact = spark.range(3000).selectExpr("id", "if(id % 3 = 0, null, id % 50) AS k").coalesce(1)
        dim = spark.range(40).selectExpr("id AS k", "id * 2 AS d")
        want = rows(fact.join(dim, "k", "left"), "id", "k", "d")
        for hot_rows in (1_000_000, 30):
            joined = joins.lookup_join(fact, dim, "k", hot_rows=hot_rows, fraction=1.0, tasks=20)
            assert rows(joined, "id", "k", "d") == want
            used = joined.groupBy(F.spark_partition_id()).count().collect()
            assert len(used) > 12 and max(r["count"] for r in used) < 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_salt_spreads_a_hot_key_and_missing_keys(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 2 == 0, 7).cast("bigint")
        fact = spark.range(0, 4000, 1, 8).select("id", key.alias("k"))
        dim = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("d"))
        joined = joins.lookup_join(fact, dim, "k", hot_rows=100, fraction=1.0)
        assert joined.count() == 4000
        plan = joined._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "_salt" in plan
        sizes = [len(p) for p in joined.select("id").rdd.glom().collect()]
        assert max(sizes) < 4000 * 0.75
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_an_aggregate_below_the_limit_is_broadcast_and_above_it_salted(spark):
    fact = spark.range(0, 30_000, 1, 4).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("k"))
    rows_ = spark.range(4000).select((F.col("id") % 1000).alias("k"))
    dim = rows_.groupBy("k").agg(F.count("*").alias("n"))
    joined = joins.lookup_join(fact, dim, "k", bounded_by=rows_, hot_rows=500, fraction=1.0)
    want = rows(fact.join(dim, "k", "left"))
    assert rows(joined) == want
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        salted = joins.lookup_join(fact, dim, "k", bounded_by=rows_, hot_rows=500, fraction=1.0)
        assert rows(salted) == want
        assert "_salt" in salted._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_more_hot_keys_than_a_thousand(spark):
    fact = spark.range(0, 60_000, 1, 4).select((F.col("id") % 3000).alias("k"))
    dim = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    hot = joins.hot_keys(fact, "k", hot_rows=10, fraction=1.0)
    assert len(hot) == 3000
    assert joins.salted_lookup(fact, dim, "k", "inner", hot).filter("d = 2 * k").count() == 60_000


def test_a_key_column_is_probed_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(joins, "hot_keys", lambda *a: calls.append(a) or [])
    for _ in range(3):
        joins.known_hot_keys(spark.range(77).withColumnRenamed("id", "k"), "k", 5, 1.0)
    assert len(calls) == 1
    # Batches of a stream are ever new plans: what is remembered stays bounded.
    for i in range(joins.PROBES + 20):
        joins.known_hot_keys(spark.range(1000 + i).withColumnRenamed("id", "k"), "k", 5, 1.0)
    assert len(joins._probes) <= joins.PROBES


def test_small_dims_are_broadcast(spark, tmp_path):
    spark.range(100).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    fact = spark.range(1000).select((F.col("id") % 10).alias("k"))
    plan = joins.lookup_join(fact, dim, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_salt" not in plan
