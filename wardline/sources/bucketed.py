"""Tables clustered by the hash of a key, which new batches meet without moving them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.dedup import first_per_key, identity_key
from wardline.sources.store import shared_dir

KEY = "event_key"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def save_bucketed(df: DataFrame, key: str, buckets: int | None = None, name: str | None = None) -> str:
    """Stores a frame in a table clustered and sorted by `key`, or appends to it; gives the table's name.

    With as many buckets as shuffle partitions, a batch that is grouped by the key meets its buckets
    in the same tasks. One file per bucket is written, so `key` should be nearly unique.
    """
    spark = df.sparkSession
    buckets = buckets or shuffle_partitions(spark)
    new = name is None or not spark.catalog.tableExists(name)
    name = name or f"wardline_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    if new:
        writer = writer.option("path", shared_dir(spark, name))
    writer.mode("errorifexists" if new else "append").saveAsTable(name)
    return name


def keyed(events: DataFrame, id_column: str = "id") -> DataFrame:
    return events.withColumn(KEY, identity_key(events, id_column))


def new_events(batch: DataFrame, store: str, id_column: str = "id", ts: str = "ts") -> DataFrame:
    """First rows of a batch's events that are not in the table `store`, with their KEY.

    The batch is reduced to a row per event, which is its only exchange: the table lies by the same
    key, so its files are merged where they are. Events without an id are compared as a whole.
    """
    first = first_per_key(keyed(batch, id_column), [KEY], [ts])
    known = batch.sparkSession.table(store).select(KEY)
    # A store is never small; a broadcast of its keys would grow with it.
    return first.join(known.hint("merge"), KEY, "left_anti")


def add_new_events(batch: DataFrame, store: str, **names) -> None:
    """Appends a batch's new events to the store."""
    spark = batch.sparkSession
    buckets = next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {store}").collect() if r.col_name == "Num Buckets")
    save_bucketed(new_events(batch, store, **names).select(*spark.table(store).columns), KEY, int(buckets), store)
