"""Event store by day with a manifest: batches count once, and the newest rows are found from the back."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators.recent import latest
from wardline.sources.store import FOLD, fold_writer, numbered, read_parts

# What Spark names the folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
MANIFEST = "batch bigint, folder string, day date, n bigint, first timestamp, last timestamp"


def committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether a batch is in the manifest."""
    folded = numbered(spark, f"{path}/manifest", "upto")[-1:]
    return bool(folded and batch_id <= folded[0]) or batch_id in numbered(spark, f"{path}/manifest", "part")


def day_store_writer(path: str, ts: str = "ts", fold: int = FOLD):
    """`foreachBatch` function that stores a batch's events by day.

    Files go to a new folder first; the manifest row that names it, with the count and times of
    each of its days, is written last. Readers see only what the manifest names, so a batch that
    failed in between leaves files that nobody reads, and a batch that is done is not written again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if committed(spark, path, batch_id):
            return
        folder = f"written={batch_id}-{uuid.uuid4().hex[:12]}"
        batch.withColumn("day", F.col(ts).cast("date")).write.partitionBy("day").parquet(f"{path}/data/{folder}")
        commit(spark, path, batch_id, folder, batch.schema, ts, fold)

    return write


def commit(spark: SparkSession, path: str, batch_id: int, folder: str, schema: T.StructType, ts: str = "ts", fold: int = FOLD) -> None:
    """Adds a written folder to the manifest; its counts come from the files themselves."""
    at = F.col(ts).cast("timestamp")
    rows = _files(spark, path, [folder], schema)
    days = rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.max(at).alias("last"))
    entry = days.select(F.lit(batch_id).cast("bigint").alias("batch"), F.lit(folder).alias("folder"), "day", "n", "first", "last")
    fold_writer(f"{path}/manifest", lambda rows: rows, fold)(entry, batch_id)


def _files(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    known = T.StructType([*schema.fields, T.StructField("written", T.StringType()), T.StructField("day", T.DateType())])
    if not folders:
        return spark.createDataFrame([], known).drop("written")
    read = spark.read.schema(known).option("basePath", f"{path}/data")
    return read.parquet(*[f"{path}/data/{f}" for f in folders]).drop("written")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_parts(spark, f"{path}/manifest", MANIFEST)


def read_day_store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The events of all batches in the manifest, with their `day`."""
    folders = [r.folder for r in manifest(spark, path).select("folder").distinct().collect()]
    return _files(spark, path, sorted(folders), schema)


def days_from_the_back(spark: SparkSession, path: str, n: int) -> tuple[list[date | None], list[str]]:
    """The newest days that hold at least `n` events together, and the folders of their files.

    One manifest row for a day of a batch is read, no event. Events without a time come last.
    """
    rows = manifest(spark, path)
    counts = {r.day: r.n for r in rows.groupBy("day").agg(F.sum("n").alias("n")).collect()}
    days: list[date | None] = []
    held = 0
    for day in sorted(counts, key=lambda d: (d is not None, d or date.min), reverse=True):
        if held >= n:
            break
        days.append(day)
        held += counts[day]
    known = [d for d in days if d is not None]
    wanted = F.col("day").isin(known) if known else F.lit(False)
    wanted = wanted | F.col("day").isNull() if None in days else wanted
    found = rows.filter(wanted).select("folder", "day").distinct().collect()
    return days, sorted(f"{r.folder}/day={r.day or NO_DAY}" for r in found)


def newest(spark: SparkSession, path: str, schema: T.StructType, n: int, ts: str = "ts", id_column: str = "id") -> DataFrame:
    """The newest `n` events, newest first, from the newest days' files only."""
    folders = days_from_the_back(spark, path, n)[1]
    return latest(_files(spark, path, folders, schema).drop("day"), n, ts, id_column)


def stored_count(spark: SparkSession, path: str) -> int:
    """Events in the store, from the manifest."""
    return manifest(spark, path).agg(F.sum("n")).first()[0] or 0
