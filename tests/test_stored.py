"""Keyed state, day store and manifest, bucketed store, segments and daily moments."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardline.operators import day_moments, dedup, recent
from wardline.sources import bucketed, day_store, segments, store
from wardline.streaming import live, state

T0 = datetime(2024, 1, 1)
EVENTS = "id bigint, ts timestamp, ip string, threat_score int"


def events(spark, numbers, days=30):
    """Events over some days, a third of them from one ip, one in 50 without a time."""
    at = F.lit(T0) + F.make_dt_interval(F.col("id") % days, F.col("id") % 24, F.col("id") % 60)
    made = spark.createDataFrame([(i,) for i in numbers], "id bigint").select(
        "id",
        F.when(F.col("id") % 50 != 49, at).cast("timestamp").alias("ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("ip"), F.col("id") % 20)).alias("ip"),
        (F.col("id") % 101).cast("int").alias("threat_score"),
    )
    return made


def arrive(frame, path):
    frame.coalesce(1).write.mode("append").parquet(path)


# First observations


def test_first_seen_in_any_order_over_restarts(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / d) for d in ("in", "first", "c"))
    known = 0
    for part in ([*range(200, 300)], [*range(0, 200, 2), *range(200, 250)], [*range(1, 200, 2)]):
        arrive(events(spark, part), source)
        known = spark.read.schema(EVENTS).parquet(source)
        stream = spark.readStream.schema(EVENTS).parquet(source)
        query = state.start_first_seen(stream, path, checkpoint, available_now=True, fold=2)
        assert query.awaitTermination(100)
        schema = "id bigint, ts timestamp, ip string, threat_score int"
        assert rows(state.read_first_seen(spark, path, schema)) == rows(dedup.first_seen(known))
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_first_seen_passes_on_few_rows_of_a_hot_ip(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / d) for d in ("in", "first", "c"))
    hot = events(spark, range(900)).withColumn("ip", F.lit("hot"))
    arrive(hot, source)
    stream = spark.readStream.schema(EVENTS).parquet(source)
    assert state.start_first_seen(stream, path, checkpoint, available_now=True).awaitTermination(100)
    assert store.read_parts(spark, path, EVENTS).count() == 1
    assert rows(state.read_first_seen(spark, path, EVENTS)) == rows(dedup.first_seen(hot))


# Known reputations


def test_the_reputation_table_is_read_for_new_addresses_only(spark, tmp_path):
    table, path = str(tmp_path / "reputation"), str(tmp_path / "known")
    spark.createDataFrame([(f"ip{i}", i) for i in range(10)], "requested_ip string, score int").write.parquet(table)
    read = lambda: spark.read.schema("requested_ip string, score int").parquet(table)
    asked = lambda *names: spark.createDataFrame([(n,) for n in names], "requested_ip string")
    look_up = live.known_reputations(path, read(), fold=2)
    for _ in range(2):
        assert rows(look_up(asked("ip1", "ip2", "stranger"), 0)) == [("ip1", 1), ("ip2", 2)]
    assert rows(look_up(asked("ip2", "ip3"), 1)) == [("ip2", 2), ("ip3", 3)]
    # All are known now: the table may be gone.
    for file in (tmp_path / "reputation").iterdir():
        file.rename(tmp_path / f"gone-{file.name.strip('.')}")
    look_up = live.known_reputations(path, spark.createDataFrame([], read().schema), fold=2)
    for number in range(2, 7):
        assert rows(look_up(asked("ip3", "ip1", "stranger"), number)) == [("ip1", 1), ("ip3", 3)]
    assert rows(look_up(asked(), 7)) == []


# Day store


def test_newest_rows_read_the_last_days_only(spark, tmp_path):
    path = str(tmp_path / "store")
    write = day_store.day_store_writer(path, fold=3)
    every = events(spark, range(600))
    parts = [every.filter(F.col("id") % 5 == k) for k in range(5)]
    for number, part in enumerate(parts):
        write(part, number)
    assert rows(day_store.read_day_store(spark, path, every.schema).drop("day")) == rows(every)
    assert day_store.stored_count(spark, path) == 600
    page = day_store.newest(spark, path, every.schema, 10)
    assert [r.id for r in page.collect()] == [r.id for r in recent.latest(every, 10).collect()]
    assert {f.rsplit("/", 2)[1] for f in page.inputFiles()} == {"day=2024-01-30"}
    assert day_store.days_from_the_back(spark, path, 10)[0] == [(T0 + timedelta(days=29)).date()]
    # Late events of an old day, and a day that is new.
    write(events(spark, range(600, 640), 3), 5)
    write(spark.createDataFrame([(1000, T0 + timedelta(days=40), "x", 1)], EVENTS), 6)
    whole = day_store.read_day_store(spark, path, every.schema).drop("day")
    assert whole.count() == 641
    for n in (1, 25, 640, 5000):
        got = day_store.newest(spark, path, every.schema, n)
        assert [r.id for r in got.collect()] == [r.id for r in recent.latest(whole, n).collect()]


def test_a_failed_batch_counts_once(spark, tmp_path, monkeypatch):
    path, every = str(tmp_path / "store"), events(spark, range(90))
    write = day_store.day_store_writer(path, fold=2)
    write(every.filter("id < 30"), 0)

    def lost(*args):
        raise RuntimeError("lost between files and manifest")

    with monkeypatch.context() as patch:
        patch.setattr(day_store, "commit", lost)
        with pytest.raises(RuntimeError):
            write(every.filter("id between 30 and 59"), 1)
    assert day_store.read_day_store(spark, path, every.schema).count() == 30
    for _ in range(2):
        write(every.filter("id between 30 and 59"), 1)
        write(every.filter("id >= 60"), 2)
    assert rows(day_store.read_day_store(spark, path, every.schema).drop("day")) == rows(every)
    # The files of the failed attempt are there, and read by nobody.
    assert len(list((tmp_path / "store" / "data").iterdir())) == 4


def test_an_empty_store(spark, tmp_path):
    schema = spark.createDataFrame([], EVENTS).schema
    assert day_store.read_day_store(spark, str(tmp_path / "none"), schema).count() == 0
    assert day_store.newest(spark, str(tmp_path / "none"), schema, 5).count() == 0
    assert day_store.stored_count(spark, str(tmp_path / "none")) == 0


# Bucketed store


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_batch_meets_its_buckets_with_one_exchange(spark, tmp_path):
    every = events(spark, range(400))
    stored = bucketed.save_bucketed(bucketed.keyed(every.filter("id < 250")), bucketed.KEY)
    nameless = spark.createDataFrame([(None, T0, "a", 1)] * 3 + [(None, T0, "b", 1)], EVENTS)
    batch = every.filter("id >= 200").unionByName(every.filter("id >= 300")).unionByName(nameless)
    fresh = bucketed.new_events(batch, stored)
    plan = plan_of(fresh)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert fresh.count() == 152
    bucketed.add_new_events(batch, stored)
    whole = spark.table(stored).drop(bucketed.KEY)
    assert rows(whole) == rows(dedup.dedup_events(every.unionByName(nameless)))
    # Once more, and nothing is new.
    assert bucketed.new_events(batch, stored).count() == 0
    # Another number of buckets than shuffle partitions: the store still stays where it is.
    other = bucketed.save_bucketed(bucketed.keyed(every.filter("id < 250")), bucketed.KEY, 16)
    plan = plan_of(bucketed.new_events(batch, other))
    assert "Exchange" not in plan[plan.index("Scan parquet spark_catalog") - 400 : plan.index("Scan parquet spark_catalog")]
    assert bucketed.new_events(batch, other).count() == 152


# Segments


def collected(spark, stream, tmp_path, name, trigger=None):
    out = str(tmp_path / f"out-{name}")
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / f"c-{name}"))
    query = (writer.trigger(availableNow=True) if trigger is None else writer).start()
    if trigger is None:
        assert query.awaitTermination(100)
    else:
        trigger(query)
        query.stop()
    return query, sorted((r.offset, r.value) for r in spark.read.schema(segments.SCHEMA).parquet(out).collect())


def messages(spark, first, last):
    return spark.range(first, last).select(F.format_string('{"id":"%d"}\nend', "id").alias("value"))


def test_segments_number_their_messages(spark, tmp_path):
    path = str(tmp_path / "topic")
    assert segments.append_messages(messages(spark, 0, 0), path) == (0, 0)
    assert segments.append_messages(messages(spark, 0, 70), path) == (0, 70)
    assert segments.append_messages(messages(spark, 70, 100), path) == (70, 100)
    earliest = segments.read_segments(spark, path, "earliest")
    _, got = collected(spark, earliest, tmp_path, "all")
    assert [o for o, _ in got] == list(range(100))
    assert {v for _, v in got} == {f'{{"id":"{i}"}}\nend' for i in range(100)}
    _, some = collected(spark, segments.read_segments(spark, path, 65), tmp_path, "some")
    assert some == got[65:]
    # A restart goes on from the checkpoint, whatever the start says.
    segments.append_messages(messages(spark, 100, 120), path)
    _, more = collected(spark, earliest, tmp_path, "all")
    assert [o for o, _ in more] == list(range(120))


def test_latest_and_bounded_batches(spark, tmp_path):
    path = str(tmp_path / "topic")
    segments.append_messages(messages(spark, 0, 50), path)

    def later(query):
        query.processAllAvailable()
        segments.append_messages(messages(spark, 50, 90), path)
        query.processAllAvailable()

    _, got = collected(spark, segments.read_segments(spark, path, "latest"), tmp_path, "late", later)
    assert [o for o, _ in got] == list(range(50, 90))
    with pytest.raises(ValueError):
        segments.read_segments(spark, path, "earliest", 30)
    bounded = segments.read_segments(spark, path, "earliest", 30, str(tmp_path / "c-bounded"))
    for total in (90, 170):
        query, got = collected(spark, bounded, tmp_path, "bounded", lambda q: q.processAllAvailable())
        assert [o for o, _ in got] == list(range(total))
        assert max(p.numInputRows for p in query.recentProgress) <= 30
        segments.append_messages(messages(spark, 90, 170), path)


# Daily moments


def test_merged_moments_are_those_of_one_pass(spark):
    frame = events(spark, range(900)).withColumns({"a": F.sqrt("id") + 1e6, "b": F.lit(0.2), "c": F.when(F.col("id") % 4 > 0, F.col("id"))})
    daily = day_moments.day_moments(frame, ["a", "b", "c"])
    late = day_moments.day_moments(frame.filter("id % 7 = 0"), ["a", "b", "c"])
    early = day_moments.day_moments(frame.filter("id % 7 > 0"), ["a", "b", "c"])
    for parts in (daily, late.unionByName(early)):
        merged = {r.feature: r for r in day_moments.merge_moments(parts).collect()}
        for f in "abc":
            want = frame.agg(F.count(f).alias("n"), F.avg(f).alias("mean"), F.stddev_samp(f).alias("sd")).first()
            assert merged[f].n == want.n and merged[f].mean == pytest.approx(want.mean, rel=1e-12)
            assert (merged[f].m2 / (want.n - 1)) ** 0.5 == pytest.approx(want.sd, rel=1e-9, abs=1e-9)
        scaled = day_moments.scale_by(frame, day_moments.merge_moments(parts), ["a", "b"], ["id"])
        assert scaled.filter("b <> 0").count() == 0
        spread = scaled.agg(F.avg("a"), F.stddev_samp("a")).first()
        assert tuple(spread) == pytest.approx((0, 1), abs=1e-6)
    none = day_moments.merge_moments(daily.limit(0))
    assert none.count() == 0


def test_the_fold_keeps_moments(spark, tmp_path):
    write = store.fold_writer(str(tmp_path / "m"), lambda rows: rows, fold=2)
    frame = events(spark, range(200)).withColumn("a", F.col("id") * 1.5)
    for k in range(5):
        write(day_moments.day_moments(frame.filter(F.col("id") % 5 == k), ["a"]), k)
    merged = day_moments.merge_moments(store.read_parts(spark, str(tmp_path / "m"), "day date, feature string, n bigint, mean double, m2 double"))
    assert merged.first().n == 200 and merged.first().mean == pytest.approx(99.5 * 1.5)
