import json
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wardline import schemas
from wardline.functions import fixed_values as fv
from wardline.operators import stats
from wardline.plans import queries
from wardline.sources import store, topic
from wardline.streaming import counters, ingest, live

T0 = datetime(2024, 1, 1)


def message(i, minutes=0, **extra):
    ts = (T0 + timedelta(minutes=minutes)).isoformat() + "+00:00"
    event = {
        "id": f"e{i}", "event_type": "ip_scan", "source": "abuseipdb", "threat_level": "high",
        "threat_score": 70, "timestamp": ts, "payload": {"message": "m", "country": "DE"},
    }
    return json.dumps(event | extra)


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_decode_fills_defaults_and_keeps_bad_text_apart(spark):
    texts = [message(1), '{"id":"x"}', "broken {", '{"id":"y","threat_score":null,"timestamp":"never"}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    out = {r["id"]: r for r in topic.decode_signals(df).collect()}
    assert set(out) == {"e1", "x", "y"}
    assert out["e1"]["ts"] == T0 and out["e1"]["payload"]["country"] == "DE"
    assert (out["x"]["threat_level"], out["x"]["threat_score"], out["x"]["ts"]) == ("low", 0, None)
    assert out["y"]["ts"] is None
    assert rows(topic.undecodable(df)) == [("broken {",)]
    binary = df.select(F.encode("value", "utf-8").alias("value"))
    assert topic.decode_signals(binary).count() == 3


def test_encode_is_the_inverse_of_decode(spark):
    df = spark.createDataFrame([(message(i, i, _replay=True),) for i in range(3)], "value string")
    events = topic.decode_signals(df)
    texts = topic.encode_signals(events)
    assert rows(topic.decode_signals(texts)) == rows(events)
    first = json.loads(texts.first()[0])
    assert first["timestamp"] == "2024-01-01T00:00:00.000000+00:00"
    assert first["_replay"] is True and "_simulated" not in first


def test_topic_options(spark):
    options = topic.kafka_source_options("broker:9092")
    assert options["subscribe"] == fv.TOPIC and options["startingOffsets"] == "latest"
    assert options["kafka.group.id"] == fv.CONSUMER_GROUP
    # The connector is a separate package; without it Spark names the missing source.
    with pytest.raises(AnalysisException, match="kafka"):
        topic.read_topic(spark)


def test_ingest_drops_copies_and_survives_a_restart(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / d) for d in ("in", "store", "checkpoint"))
    # A third of the first file is one id; the second file repeats the first out of order.
    first = [message(i, i) for i in range(40)] + [message(0)] * 20
    write_lines(tmp_path / "in" / "a.json", first)

    def run():
        stream = ingest.read_message_files(spark, source)
        ingest.start_ingest(stream, path, checkpoint, available_now=True).awaitTermination()
        return rows(ingest.read_store(spark, path), "id")

    ids = sorted(((f"e{i}",) for i in range(40)), key=repr)
    assert run() == ids
    write_lines(tmp_path / "in" / "b.json", [message(i, i) for i in reversed(range(45))])
    assert run() == sorted(((f"e{i}",) for i in range(45)), key=repr)


def test_ingest_keeps_different_events_without_id_or_time(spark, tmp_path):
    lines = [
        '{"threat_score":1}', '{"threat_score":1}', '{"threat_score":2}', message(1), message(1),
    ]
    write_lines(tmp_path / "in" / "a.json", lines)
    stream = ingest.read_message_files(spark, str(tmp_path / "in"))
    path, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")
    ingest.start_ingest(stream, path, checkpoint, available_now=True, salts=0).awaitTermination()
    assert rows(ingest.read_store(spark, path), "threat_score") == [(1,), (2,), (70,)]


def test_counters_follow_the_store(spark, tmp_path):
    levels = [{"threat_level": level, "threat_score": s} for level, s in (("low", 1), ("high", 60))]

    def run(name, lines):
        write_lines(tmp_path / "in" / f"{name}.json", lines)
        stream = ingest.read_message_files(spark, str(tmp_path / "in"))
        path = str(tmp_path / "store")
        ingest.start_ingest(
            stream, path, str(tmp_path / "c1"), available_now=True
        ).awaitTermination()
        for start, out in (
            (counters.start_minute_counts, "minutes"),
            (counters.start_level_totals, "levels"),
        ):
            stored = ingest.stream_store(spark, path)
            start(
                stored, str(tmp_path / out), str(tmp_path / f"c-{out}"), available_now=True
            ).awaitTermination()
        batch = ingest.read_store(spark, path)
        minutes = counters.read_minute_counts(spark, str(tmp_path / "minutes"))
        totals = counters.read_level_totals(spark, str(tmp_path / "levels"))
        assert rows(minutes) == rows(stats.per_minute(batch))
        assert rows(totals) == rows(stats.level_totals(batch))
        return totals

    run("a", [message(i, i // 3, **levels[i % 2]) for i in range(20)])
    totals = run("b", [message(i, i // 3, **levels[i % 2]) for i in range(10, 40)])
    assert rows(totals) == [("high", 20, 1200), ("low", 20, 20)]


def test_push_writes_one_json_line_per_event(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", [message(i) for i in range(3)])
    stream = ingest.read_message_files(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    ingest.start_push(stream, out, str(tmp_path / "c"), available_now=True).awaitTermination()
    lines = [json.loads(r[0]) for r in spark.read.text(out).collect()]
    assert sorted(e["id"] for e in lines) == ["e0", "e1", "e2"]


def test_stream_scores_equal_batch_scores(spark, sf_dir, tmp_path):
    streamed = queries._scored_store(spark, sf_dir).persist()
    batch = queries.scored_signals(spark, sf_dir)
    columns = ("id", "rf_prediction", "cluster_name", "anomaly", "ml_adjusted_score")
    assert rows(streamed, *columns) == rows(batch, *columns)
    messages = queries.signal_messages(spark, sf_dir)
    assert rows(streamed, "id", "source", "message") == rows(messages, "id", "source", "message")
    # The trend job writes the trend of the stored history after each batch.
    scored_path = str(tmp_path / "scored")
    streamed.write.parquet(scored_path)
    as_stream = spark.readStream.schema(streamed.schema).parquet(scored_path)
    live.start_trend(
        as_stream, str(tmp_path / "newest"), str(tmp_path / "trend"), str(tmp_path / "c"),
        available_now=True,
    ).awaitTermination()
    trends = store.read_batches(
        spark, str(tmp_path / "trend"),
        "slope double, intercept double, next_predicted double, trend string, data_points bigint",
    ).drop("batch_id")
    assert rows(trends.distinct()) == rows(live.history_trend(streamed))


def late_files(tmp_path, n=120, files=6):
    """Message files with the newest events first, one per trigger."""
    for f in range(files):
        lines = [message(i, i) for i in range(n) if i * files // n == files - 1 - f]
        write_lines(tmp_path / "in" / f"{f}.json", lines + lines[:2])


def test_no_event_is_too_late(spark, tmp_path):
    late_files(tmp_path)
    stream = ingest.read_message_files(spark, str(tmp_path / "in"), per_trigger=1)
    path = str(tmp_path / "store")
    query = ingest.start_ingest(stream, path, str(tmp_path / "c1"), available_now=True)
    query.awaitTermination()
    assert len(query.recentProgress) >= 6
    stored = ingest.read_store(spark, path)
    assert stored.count() == 120 and stored.select("id").distinct().count() == 120
    follow = spark.readStream.schema(schemas.SIGNAL).option("maxFilesPerTrigger", 1).parquet(path)
    out = str(tmp_path / "minutes")
    counters.start_minute_counts(follow, out, str(tmp_path / "c2"), available_now=True, fold=4).awaitTermination()
    assert rows(counters.read_minute_counts(spark, out)) == rows(stats.per_minute(stored))


def test_undecodable_messages_are_kept(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", [message(1), "broken {", message(2)])
    lines = ingest.read_lines(spark, str(tmp_path / "in"))
    path, rejects = str(tmp_path / "store"), str(tmp_path / "rejects")
    for query in ingest.start_message_ingest(lines, path, rejects, str(tmp_path / "c"), available_now=True):
        query.awaitTermination()
    assert ingest.read_store(spark, path).count() == 2
    assert rows(spark.read.parquet(rejects)) == [("broken {",)]


def test_sums_are_folded_and_replays_count_once(spark, tmp_path):
    path, schema = str(tmp_path / "sums"), "k string, n bigint"
    write = store.sum_writer(path, ["k"], fold=4)
    for i in range(30):
        for _ in range(2):
            write(spark.createDataFrame([("a", 1), (f"b{i % 3}", i)], schema), i)
        assert len(list((tmp_path / "sums").iterdir())) <= 11
    total = {r.k: r.n for r in store.read_sums(spark, path, schema, ["k"]).collect()}
    assert total == {"a": 30} | {f"b{j}": sum(range(j, 30, 3)) for j in range(3)}
    assert store.read_sums(spark, str(tmp_path / "none"), schema, ["k"]).count() == 0


def test_the_newest_rows_roll_on(spark, tmp_path):
    path = str(tmp_path / "newest")
    write = store.newest_writer(path, lambda df: df.orderBy(F.desc("id")).limit(5))
    for i in range(12):
        for _ in range(2):
            kept = write(spark.range(i * 3, i * 3 + 3), i)
        assert [r.id for r in kept.collect()] == list(range(i * 3 + 2, max(-1, i * 3 - 3), -1))[:5]
        assert len(list((tmp_path / "newest").iterdir())) <= 2


def test_a_batch_written_twice_counts_once(spark, tmp_path):
    write = store.batch_writer(str(tmp_path / "out"))
    write(spark.range(3), 0)
    write(spark.range(3), 0)
    write(spark.range(3, 5), 1)
    assert store.read_batches(spark, str(tmp_path / "out"), "id bigint").count() == 5


def test_batch_append(spark, tmp_path):
    events = spark.createDataFrame([], schemas.SIGNAL)
    store.append_events(events, str(tmp_path / "store"))
    one = topic.decode_signals(spark.createDataFrame([(message(1),)], "value string"))
    store.append_events(one, str(tmp_path / "store"))
    store.append_events(one, str(tmp_path / "store"))
    assert ingest.read_store(spark, str(tmp_path / "store")).count() == 2


def test_a_cluster_must_name_its_shared_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        store.shared_dir(Session(), "x")
    assert store.shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_large_file_is_scored_by_many_tasks(spark):
    held = spark.range(0, 1000, 1, 1).persist()
    spread = live.dealt(held, task_rows=100)
    assert spread.rdd.getNumPartitions() == 10 and rows(spread) == rows(held)
    assert live.dealt(held, task_rows=2000).rdd.getNumPartitions() == 1
    held.unpersist()


def test_arrivals_come_in_files_of_bounded_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(queries, "ARRIVAL_ROWS", 50)
    path, files = queries.arrivals(spark, sf_dir)
    table = spark.read.parquet(path)
    of_file = table.groupBy(F.input_file_name().alias("file")).count()
    assert of_file.agg(F.max("count")).first()[0] <= 50
    assert files >= 2 and table.count() == queries.td.events(spark, sf_dir).count()
