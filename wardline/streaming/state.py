"""First observation of each address, kept as keyed state across the batches of a stream.

This is the one place where streams run Python: Spark's arbitrary keyed state has no column form.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from wardline.operators.dedup import first_per_key
from wardline.sources.store import FOLD, fold_writer, read_parts
from wardline.streaming.ingest import _start

# Keyed state with a time to live needs this store. Without data it asks for a batch again and again, so
# that a query would not end with its input; what has run out is then dropped by the next batch with data.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
# Parts into which what is left of an address's events is dealt, and how long an address is remembered.
SALTS = 1
KEPT_DAYS = 30


class Earliest(StatefulProcessor):
    """Keeps the earliest row of each key, by time (none last) and id, and gives it out when it changes."""

    def __init__(self, key: str, schema: T.StructType, ts: str, id_column: str, kept_ms: int):
        columns = self.columns = schema.names
        self.schema, self.kept_ms, self.row = schema, kept_ms, Row(key, *columns)
        self.ts, self.id = columns.index(ts), columns.index(id_column)

    def init(self, handle) -> None:
        self.first = handle.getValueState("first", self.schema, self.kept_ms)

    def _rank(self, row) -> tuple:
        at = row[self.ts]
        return at is None, 0 if at is None else at, row[self.id]

    def handleInputRows(self, key, rows, timerValues):
        # Each call of the state is a message to the store; without a value, or a live one, this is None.
        before = self.first.get()
        best = tuple(before) if before is not None else None
        for row in rows:
            row = tuple(row[c] for c in self.columns)
            if best is None or self._rank(row) < self._rank(best):
                best = row
        if before is None or best != tuple(before):
            self.first.update(best)
            yield self.row(key[0], *best)

    def close(self) -> None:
        pass


def _named(events: DataFrame, key: str) -> tuple[T.StructType, T.StructType]:
    rest = T.StructType([T.StructField(f.name, f.dataType) for f in events.schema.fields if f.name != key])
    return T.StructType([T.StructField(key, events.schema[key].dataType), *rest.fields]), rest


def _earliest_of_batches(key: str, ts: str, id_column: str):
    """Of each Arrow batch the earliest row of every key: by time (none last) and id."""
    order = [(c, "ascending") for c in (key, ts, id_column)]

    def run(batches):
        for batch in batches:
            sorted_rows = batch.take(pc.sort_indices(batch, sort_keys=order, null_placement="at_end"))
            keys = sorted_rows.column(key)
            if len(keys):
                new = pa.concat_arrays([pa.array([True]), pc.not_equal(keys[1:], keys[:-1])])
                yield sorted_rows.filter(new)

    return run


def first_seen_stream(
    events: DataFrame, key: str = "ip", ts: str = "ts", id_column: str = "id", salts: int = SALTS, kept_days: int = KEPT_DAYS
) -> DataFrame:
    """Rows that are the earliest of their key so far, as batches of a stream bring them.

    Events of one key may be a third of the stream: an Arrow batch (10,000 rows) passes on a row per key
    only, so the state sees few of them, and is asked once per key and batch and not per event. What is
    left can be dealt to `salts` parts by id, each with a state of its own: up to that many candidates of
    a key come out, of which the table that `start_first_seen` keeps has the earliest. A key without
    events for `kept_days` is forgotten. Rows without a key are left out.
    """
    # Times are whole numbers in the state: they come back from it without their time zone.
    kind = events.schema[ts].dataType
    plain = events.withColumn(ts, F.unix_micros(F.col(ts).cast("timestamp")))
    full, rest = _named(plain, key)
    known = plain.filter(F.col(key).isNotNull()).select(*full.names)
    reduced = known.mapInArrow(_earliest_of_batches(key, ts, id_column), full)
    salted = reduced.withColumn("_salt", F.pmod(F.xxhash64(id_column), F.lit(salts)))
    keeper = Earliest(key, rest, ts, id_column, kept_days * 24 * 3_600_000)
    first = salted.groupBy(key, "_salt").transformWithState(keeper, full, "Update", "ProcessingTime")
    return first.withColumn(ts, F.timestamp_micros(ts).cast(kind)).select(*events.columns)


def start_first_seen(
    events: DataFrame, path: str, checkpoint: str, key: str = "ip", ts: str = "ts", id_column: str = "id",
    available_now: bool = False, fold: int = FOLD, **state,
) -> StreamingQuery:
    """Keep the first observation of each key in the folder `path` (`read_first_seen`).

    Events may come in any order: an earlier one that comes late takes its key's place. After a
    restart the state goes on from the checkpoint, and a batch written again counts once.
    """
    spark = events.sparkSession
    write = fold_writer(path, lambda rows: first_per_key(rows, [key], [ts, id_column]), fold)
    stream = first_seen_stream(events, key, ts, id_column, **state)
    writer = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    before = {name: spark.conf.get(name) for name in SETTINGS}
    # A query takes the settings of its start.
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return _start(writer, available_now)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def read_first_seen(spark: SparkSession, path: str, schema, key: str = "ip", ts: str = "ts", id_column: str = "id") -> DataFrame:
    """First observation of each key so far; `schema` has the key first."""
    return first_per_key(read_parts(spark, path, schema), [key], [ts, id_column])
