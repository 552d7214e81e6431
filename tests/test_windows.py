"""Exact score split and the rolling trend."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardline.operators import clusters, recent, trend
from wardline.sources import store
from wardline.streaming import live

T0 = datetime(2024, 1, 1)
SCORED = "id bigint, ts timestamp, ml_adjusted_score int"


def spread(values):
    mean = sum(values) / len(values) if values else 0
    return sum((v - mean) ** 2 for v in values)


def best_split(scores):
    """Lower part's greatest score and the least squared distance, over every cut."""
    cuts = sorted(set(scores))[:-1]
    cost = lambda c: spread([s for s in scores if s <= c]) + spread([s for s in scores if s > c])
    return min(((round(cost(c), 6), c) for c in cuts), default=(0, None))


@pytest.mark.parametrize("seed", range(4))
def test_the_split_is_the_best_one(spark, seed):
    draw = random.Random(seed)
    scores = [draw.choice([0, 1, 2, 50, 97, 100]) if seed % 2 else draw.randint(0, 100) for _ in range(draw.randint(5, 400))]
    events = spark.createDataFrame([(i, None, s) for i, s in enumerate(scores)], "id int, ts timestamp, threat_score int")
    split = clusters.split_by_score(events, None).collect()
    low, high = ([r.score for r in split if r.cluster == c] for c in (0, 1))
    cost, cut = best_split(scores)
    assert sorted(low + high) == sorted(scores)
    assert spread(low) + spread(high) == pytest.approx(cost)
    assert max(low) == cut


def test_equal_cuts_nulls_and_one_score(spark):
    schema = "id int, ts timestamp, threat_score int"
    even = spark.createDataFrame([(i, None, s) for i, s in enumerate([0, 0, 10, 10, 20, 20])], schema)
    assert rows(clusters.split_by_score(even).groupBy("cluster").count()) == [(0, 2), (1, 4)]
    same = spark.createDataFrame([(i, None, 7) for i in range(9)], schema)
    assert rows(clusters.split_by_score(same).groupBy("cluster").count()) == [(0, 9)]
    missing = spark.createDataFrame([(i, None, None if i % 2 else 90) for i in range(8)], schema)
    assert rows(clusters.split_by_score(missing).groupBy("cluster", "score").count()) == [(0, 0.0, 4), (1, 90.0, 4)]
    assert clusters.split_by_score(same.limit(0)).count() == 0


def scored_rows(spark, n, seed):
    draw = random.Random(seed)
    made = [(i, T0 + timedelta(seconds=draw.randrange(0, 40 * 3600)), draw.randint(0, 100)) for i in range(n)]
    made += [(n, None, 50), (n + 1, T0, None)]
    return spark.createDataFrame(made, SCORED)


@pytest.mark.parametrize("hours", [1, 6])
def test_moments_give_the_trend(spark, hours):
    scored = scored_rows(spark, 300, 1)
    moments = trend.bucket_moments(scored, "ml_adjusted_score", hours=hours)
    assert rows(trend.trend_of_moments(moments, hours=hours)) == rows(trend.score_trend(scored, "ml_adjusted_score"))
    shifted = scored.withColumn("ml_adjusted_score", F.col("id") % 100)
    both = trend.bucket_moments(shifted, "ml_adjusted_score", hours=hours).unionByName(moments)
    added = store.add_up(both, ["bucket"], first_hour=F.min, last_hour=F.max)
    whole = scored.unionByName(shifted)
    assert rows(trend.trend_of_moments(added, hours=hours)) == rows(trend.score_trend(whole, "ml_adjusted_score"))


def test_few_rows_and_one_instant(spark):
    for n in (0, 1, 2):
        some = scored_rows(spark, 10, 2).filter("ts is not null").limit(n)
        moments = trend.bucket_moments(some, "ml_adjusted_score")
        assert rows(trend.trend_of_moments(moments)) == rows(trend.score_trend(some, "ml_adjusted_score"))
    instant = spark.createDataFrame([(i, T0 + timedelta(minutes=7), i * 10) for i in range(9)], SCORED)
    moments = trend.bucket_moments(instant, "ml_adjusted_score")
    assert rows(trend.trend_of_moments(moments)) == rows(trend.score_trend(instant, "ml_adjusted_score"))


@pytest.mark.parametrize("n, newest_first", [(40, True), (40, False), (1000, True)])
def test_the_window_rolls_over_batches(spark, tmp_path, n, newest_first):
    scored = scored_rows(spark, 240, 3)
    source, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "trend"), str(tmp_path / "c")
    order = F.col("ts").desc() if newest_first else F.xxhash64("id")
    listed = scored.orderBy(order).collect()
    wanted = {}
    for i in range(5):
        some = spark.createDataFrame(listed[i * 50 : i * 50 + 50], SCORED)
        some.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCORED).parquet(source)
        # A query per file: each one goes on from the checkpoint of the one before.
        live.start_trend(stream, str(tmp_path / "history"), path, checkpoint, n, True, fold=2).awaitTermination()
        so_far = spark.createDataFrame(listed[: i * 50 + 50], SCORED)
        wanted[i] = rows(trend.score_trend(recent.latest(so_far, n), "ml_adjusted_score"))
        if i in (0, 4):
            assert rows(live.last_trend(spark, path)) == wanted[i]
    trends = live.read_trends(spark, path)
    assert {i: rows(trends.filter(F.col("batch_id") == i).drop("batch_id")) for i in range(5)} == wanted
    # Hours that have left the window are gone from the folded tables.
    kept = store.read_parts(spark, str(tmp_path / "history" / "rows"), SCORED.replace("score int", "score double") + ", bucket bigint")
    if newest_first and n == 40:
        assert kept.count() < 150
