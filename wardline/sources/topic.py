"""JSON event topic: decode, encode and the Kafka options around both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wardline import schemas
from wardline.functions import fixed_values as fv
from wardline.functions.rules import or_default

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def _parsed(messages: DataFrame, value: str) -> DataFrame:
    text = F.col(value).cast("string")
    event = F.from_json(
        text, schemas.SIGNAL_WIRE, {"columnNameOfCorruptRecord": "_corrupt_record"}
    )
    return messages.select(event.alias("e"), text.alias("_text"))


def decode_signals(messages: DataFrame, value: str = "value") -> DataFrame:
    """Events of a frame with a JSON text or binary column, defaults filled in."""
    return (
        _parsed(messages, value)
        .filter("e is not null and e._corrupt_record is null")
        .select(
            "e.id",
            "e.event_type",
            "e.source",
            or_default(F.col("e.threat_level"), fv.DEFAULT_LEVEL).alias("threat_level"),
            or_default(F.col("e.threat_score"), 0).alias("threat_score"),
            F.try_to_timestamp(F.col("e.timestamp")).alias("ts"),
            "e.payload",
            or_default(F.col("e._simulated"), False).alias("_simulated"),
            or_default(F.col("e._replay"), False).alias("_replay"),
        )
    )


def undecodable(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages that `decode_signals` leaves out, as text."""
    return (
        _parsed(messages, value)
        .filter("e is null or e._corrupt_record is not null")
        .select(F.col("_text").alias(value))
    )


def encode_signals(signals: DataFrame) -> DataFrame:
    """One JSON text per event; null fields are left out, as are flags that are not set."""
    fields = []
    for name in signals.columns:
        column = F.col(name)
        if name == "ts":
            column, name = F.date_format(column, ISO_FORMAT), "timestamp"
        elif name in ("_simulated", "_replay"):
            column = F.when(column, True)
        fields.append(column.alias(name))
    return signals.select(F.to_json(F.struct(*fields)).alias("value"))


def kafka_source_options(bootstrap: str = fv.BOOTSTRAP, topic: str = fv.TOPIC) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "kafka.group.id": fv.CONSUMER_GROUP,
        "startingOffsets": "latest",
    }


def read_topic(
    spark: SparkSession, bootstrap: str = fv.BOOTSTRAP, topic: str = fv.TOPIC, **options: str
) -> DataFrame:
    """Streaming events of the topic. Pass `maxOffsetsPerTrigger` to bound a micro-batch."""
    source = spark.readStream.format("kafka")
    source = source.options(**kafka_source_options(bootstrap, topic), **options)
    return decode_signals(source.load())


def topic_writer(
    signals: DataFrame,
    checkpoint: str,
    bootstrap: str = fv.BOOTSTRAP,
    topic: str = fv.TOPIC,
) -> DataStreamWriter:
    return (
        encode_signals(signals)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
