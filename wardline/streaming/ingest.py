"""Event ingest: decode, deduplicate, store, push."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardline import schemas
from wardline.operators.dedup import identity_key
from wardline.sources.topic import decode_signals, encode_signals, undecodable

WATERMARK = "1 hour"
SALTS = 64


def read_lines(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """Stream of the lines of message files, as the topic's messages come."""
    return spark.readStream.option("maxFilesPerTrigger", per_trigger).text(path)


def read_message_files(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """Stream of JSON event files, decoded like the topic's messages."""
    return decode_signals(read_lines(spark, path, per_trigger))


def dedup_stream(
    events: DataFrame,
    id_column: str = "id",
    ts: str = "ts",
    watermark: str = WATERMARK,
    salts: int = SALTS,
) -> DataFrame:
    """One row per event id within the watermark, which runs on arrival.

    An event is new if its id has not arrived within the watermark, however old its own time is:
    late and disordered events all stay. Copies of one id may be a third of the stream. The first
    pass drops copies per (id, input partition group), so at most `salts` copies of an id meet in
    the second. `salts=0` leaves out the first pass where copies are known to be few. An event
    without a time counts as of its arrival.
    """
    now = F.current_timestamp()
    keyed = (
        events.withColumn("_key", identity_key(events, id_column))
        .withColumn(ts, F.coalesce(F.col(ts), now))
        .withColumn("_arrived", now)
        .withWatermark("_arrived", watermark)
    )
    if salts:
        group = F.pmod(F.spark_partition_id(), F.lit(salts))
        keyed = keyed.withColumn("_salt", group).dropDuplicatesWithinWatermark(["_key", "_salt"])
        keyed = keyed.drop("_salt")
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_arrived")


def _start_files(
    stream: DataFrame, kind: str, path: str, checkpoint: str, available_now: bool
) -> StreamingQuery:
    writer = stream.writeStream.format(kind).option("path", path)
    return _start(writer.option("checkpointLocation", checkpoint), available_now)


def start_store(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append a stream to its own event store.

    The file sink logs which files belong to a finished batch, so readers of the store,
    streams among them, see every event once even after a failed batch was written again.
    """
    return _start_files(events, "parquet", path, checkpoint, available_now)


def start_ingest(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = False, **dedup
) -> StreamingQuery:
    """Deduplicate decoded events and append them to the store."""
    return start_store(dedup_stream(events, **dedup), path, checkpoint, available_now)


def start_message_ingest(
    messages: DataFrame, path: str, rejects: str, checkpoint: str, available_now: bool = False, **dedup
) -> tuple[StreamingQuery, StreamingQuery]:
    """`start_ingest` of raw messages; text that does not decode is appended to the table `rejects`."""
    good = start_ingest(decode_signals(messages), path, f"{checkpoint}/events", available_now, **dedup)
    bad = _start_files(undecodable(messages), "parquet", rejects, f"{checkpoint}/rejects", available_now)
    return good, bad


def read_store(spark: SparkSession, path: str, schema=schemas.SIGNAL) -> DataFrame:
    """The stored events as a batch table."""
    return spark.read.schema(schema).parquet(path)


def stream_store(spark: SparkSession, path: str, schema=schemas.SIGNAL) -> DataFrame:
    """The stored events as a stream, for counters that follow the store."""
    return spark.readStream.schema(schema).parquet(path)


def start_push(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Every new event as one line of JSON text for subscribers to pick up."""
    return _start_files(encode_signals(events), "text", path, checkpoint, available_now)


def _start(writer, available_now: bool) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
