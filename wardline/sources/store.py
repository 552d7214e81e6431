"""Event store and staged tables on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_local: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's checkpoint folder.

    Only a local session may do without `spark.checkpoint.dir`: it is all on one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="wardline-"))
        base = _local[0]
    return f"{base.rstrip('/')}/wardline/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many: cuts lineage before work that passes over the rows often."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def batch_writer(path: str):
    """`foreachBatch` function: one folder per batch, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of a store written by `batch_writer`, with the column `batch_id`."""
    columns = spark.createDataFrame([], schema).schema
    return spark.read.schema(columns.add("batch_id", T.LongType())).parquet(path)


# Batches that are added up before the sums are written anew.
FOLD = 16


def _folder(spark: SparkSession, path: str):
    """The file system of a folder, which may be any that Spark writes to, and the folder on it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    files, place = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def numbered(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the finished tables `kind-<number>` in a folder, ascending."""
    files, place = _folder(spark, path)
    if not files.exists(place):
        return []
    found = []
    for status in files.listStatus(place):
        name, _, number = status.getPath().getName().partition("-")
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name == kind and number.isdigit() and files.exists(done):
            found.append(int(number))
    return sorted(found)


def forget(spark: SparkSession, path: str, kind: str, before: int) -> None:
    """Removes the tables `kind-<number>` with smaller numbers."""
    for number in numbered(spark, path, kind):
        if number < before:
            files, place = _folder(spark, f"{path}/{kind}-{number}")
            files.delete(place, True)


def fold_writer(path: str, merge: Callable[[DataFrame], DataFrame], fold: int = FOLD):
    """`foreachBatch` function that adds a batch's rows to those in `path`.

    A batch is the table `part-<id>`, which a replayed batch replaces. After `fold` of them what
    `merge` makes of all rows so far is written as `upto-<id>`; the tables that it holds are removed
    then, so that readers of the last ones are not disturbed and the number of tables stays bounded.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folded = numbered(spark, path, "upto")
        last = folded[-1] if folded else -1
        if batch_id <= last:
            return
        batch.write.mode("overwrite").parquet(f"{path}/part-{batch_id}")
        if batch_id - last >= fold:
            merge(read_parts(spark, path, batch.schema)).write.mode("overwrite").parquet(f"{path}/upto-{batch_id}")
            forget(spark, path, "upto", last)
            forget(spark, path, "part", last + 1)

    return write


def read_parts(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of the newest `upto` table and the parts after it."""
    empty = spark.createDataFrame([], schema)
    folded = numbered(spark, path, "upto")[-1:]
    parts = [n for n in numbered(spark, path, "part") if not folded or n > folded[0]]
    paths = [f"{path}/upto-{n}" for n in folded] + [f"{path}/part-{n}" for n in parts]
    return spark.read.schema(empty.schema).parquet(*paths) if paths else empty


def add_up(rows: DataFrame, keys: list[str], **others: Callable) -> DataFrame:
    """Sums per key; `others` names the aggregates of columns that are not summed."""
    values = [c for c in rows.columns if c not in keys]
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return rows.groupBy(*keys).agg(*[others.get(v, F.sum)(v).cast(kinds[v]).alias(v) for v in values])


def sum_writer(path: str, keys: list[str], fold: int = FOLD):
    """`fold_writer` that adds a batch's counts to the sums in `path`."""
    return fold_writer(path, lambda rows: add_up(rows, keys), fold)


def read_sums(spark: SparkSession, path: str, schema, keys: list[str]) -> DataFrame:
    """Sums per key over the newest `upto` table and the parts after it."""
    return add_up(read_parts(spark, path, schema), keys)


def newest_writer(path: str, newest, keep: int = 2):
    """`foreachBatch` helper: the rolling table `newest(old rows and batch)` as `newest-<id>`.

    Returns the table written. A replayed batch starts from the table before it, as the first time.
    """

    def write(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        before = [n for n in numbered(spark, path, "newest") if n < batch_id][-1:]
        rows = batch
        if before:
            rows = spark.read.schema(batch.schema).parquet(f"{path}/newest-{before[0]}").unionByName(batch)
        target = f"{path}/newest-{batch_id}"
        newest(rows).write.mode("overwrite").parquet(target)
        forget(spark, path, "newest", batch_id - keep + 1)
        return spark.read.schema(batch.schema).parquet(target)

    return write
