"""Live enrichment, scoring and trend over stored batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardline.functions import fixed_values as fv
from wardline.operators.events import describe_signals
from wardline.operators.recent import latest
from wardline.operators.reputation import KEY, enrich_signals
from wardline.operators.scoring import score_records
from wardline.operators.training import ThreatModel
from wardline.operators.trend import MOMENTS, bucket_moments, bucket_of, newest_buckets, score_trend, trend_of_moments
from wardline.sources.store import FOLD, add_up, batch_writer, fold_writer, numbered, read_batches, read_parts
from wardline.streaming.ingest import _start

# Rows of a batch that one task scores, and the most tasks of a batch. A file or a merged partition may hold
# millions of them, and a row costs far more to score than to read.
TASK_ROWS, MAX_TASKS = 20_000, 10_000

RESULTS = (
    "id", "ts", "ip", "threat_score", "threat_level", "source", "message", "anomaly",
    "anomaly_score", "rf_prediction", "rf_confidence", "cluster_name", "ml_adjusted_score",
)


def score_signals(
    signals: DataFrame,
    reputation: DataFrame,
    model: ThreatModel,
    bounded_by: DataFrame | None = None,
) -> DataFrame:
    """Signals with reputation, description and model results."""
    described = describe_signals(enrich_signals(signals, reputation, bounded_by))
    return score_records(described, model).select(*RESULTS)


def dealt(rows: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """A held frame dealt to a task per `task_rows` rows, however few partitions it came in."""
    tasks = min(rows.count() // task_rows, MAX_TASKS)
    return rows.repartition(tasks) if tasks > 1 else rows


def known_reputations(path: str, reputation: DataFrame, fold: int = FOLD):
    """Function (asked, batch id) that gives the reputations of a batch's addresses, from the folder `path`.

    The folder keeps what was looked up before, and of addresses without a record that there is none. Only
    for addresses that no batch asked for is `reputation` read; a batch without such leaves it alone. A
    batch that is written again finds its addresses there already.
    """
    marked = reputation.withColumn("_found", F.lit(True))
    schema = marked.schema

    def look_up(asked: DataFrame, batch_id: int) -> DataFrame:
        spark = asked.sparkSession
        if batch_id not in numbered(spark, path, "part"):
            fresh = asked.join(read_parts(spark, path, schema).select(KEY), KEY, "left_anti").persist()
            try:
                found = fresh.join(marked, KEY, "left") if fresh.limit(1).count() else spark.createDataFrame([], schema)
                fold_writer(path, lambda rows: rows, fold)(found.select(*schema.names), batch_id)
            finally:
                fresh.unpersist()
        return read_parts(spark, path, schema).filter("_found").drop("_found").join(asked, KEY, "left_semi")

    return look_up


def start_scoring(
    signals: DataFrame,
    reputation: DataFrame,
    model: ThreatModel,
    path: str,
    checkpoint: str,
    bounded_by: DataFrame | None = None,
    available_now: bool = False,
    known: str | None = None,
) -> StreamingQuery:
    """Score a stream of signals batch by batch.

    Each batch is a plain frame, so it gets the same hot-key handling as a batch job. It is held
    while it is scored, as the search for hot keys and the scoring both read it, and is scored by as many
    tasks as its rows ask for, whatever files they came in. `reputation` should
    be a stored table: it is read again for every batch, reduced to the batch's addresses, or, with
    a folder `known`, for addresses that come for the first time (`known_reputations`).
    """
    write = batch_writer(path)
    look_up = known_reputations(known, reputation) if known else lambda asked, _: reputation.join(asked, KEY, "left_semi")

    def score(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            asked = held.filter("ip is not null").select(F.col("ip").alias(KEY)).distinct()
            write(score_signals(dealt(held), look_up(asked, batch_id), model, bounded_by), batch_id)
        finally:
            held.unpersist()

    writer = signals.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def history_trend(scored: DataFrame, n: int | None = fv.TREND_ROWS, asof=None) -> DataFrame:
    """Trend of the adjusted scores over the newest `n` rows of the scored store."""
    return score_trend(latest(scored, n), "ml_adjusted_score", "ts", asof)


def rolling_trend(moments: DataFrame, kept: DataFrame, n: int | None, asof=None) -> DataFrame:
    """Trend of the newest `n` rows from bucket moments.

    Whole buckets count by their moments. Only of the bucket that the window cuts are rows read:
    `kept` holds at least those, with their `bucket`.
    """
    whole, edge, left = (moments, None, 0) if n is None else newest_buckets(moments, n)
    if edge is None:
        return trend_of_moments(whole, asof)
    cut = latest(kept.filter(F.col("bucket") == edge), left)
    return trend_of_moments(whole.unionByName(bucket_moments(cut, "ml_adjusted_score")), asof)


def _added(moments: DataFrame) -> DataFrame:
    return add_up(moments, ["bucket"], first_hour=F.min, last_hour=F.max)


def start_trend(
    scored: DataFrame, history: str, path: str, checkpoint: str, n: int = fv.TREND_ROWS, available_now: bool = False, fold: int = FOLD
) -> StreamingQuery:
    """After each batch of newly scored rows, write the trend of the newest `n` rows so far.

    The folder `history` keeps each hour's moments and the rows by hour. A batch adds its own to both;
    the trend is worked out from moments and the rows of one hour, and hours that have left the
    window go when tables are folded. Rows may arrive in any order; one without a time is in no trend.
    """
    write = batch_writer(path)

    def from_edge(rows: DataFrame, moments: DataFrame) -> DataFrame:
        edge = newest_buckets(moments, n)[1]
        return rows if edge is None else rows.filter(F.col("bucket") >= edge)

    def merged(moments: DataFrame) -> DataFrame:
        return from_edge(_added(moments), _added(moments))

    add = fold_writer(f"{history}/moments", merged, fold)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        add(bucket_moments(batch, "ml_adjusted_score"), batch_id)
        moments = _added(read_parts(batch.sparkSession, f"{history}/moments", MOMENTS))
        timed = batch.filter("ts is not null").withColumn("bucket", bucket_of(F.col("ts")))
        timed = timed.withColumn("ml_adjusted_score", F.col("ml_adjusted_score").cast("double"))
        keep = fold_writer(f"{history}/rows", lambda rows: from_edge(rows, moments), fold)
        keep(timed.sortWithinPartitions("bucket"), batch_id)
        kept = read_parts(batch.sparkSession, f"{history}/rows", timed.schema)
        write(rolling_trend(moments, kept, n), batch_id)

    kept = scored.select("id", "ts", "ml_adjusted_score")
    writer = kept.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def read_trends(spark: SparkSession, path: str) -> DataFrame:
    """The trend after each batch, with its `batch_id`."""
    columns = "slope double, intercept double, next_predicted double, trend string, data_points bigint"
    return read_batches(spark, path, columns)


def last_trend(spark: SparkSession, path: str) -> DataFrame:
    """The trend after the newest batch."""
    trends = read_trends(spark, path)
    return trends.filter(F.col("batch_id") == trends.agg(F.max("batch_id")).scalar()).drop("batch_id")
