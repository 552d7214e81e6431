"""Linear score trend as one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions.rules import or_default, trend_word


def _hours(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(3.6e9)


def trend_aggregates(score: str = "threat_score", ts: str = "ts") -> list[Column]:
    """Aggregates that `trend_columns` turns into a trend; add them to any `agg`.

    Hours count from the epoch here, so that one pass is enough: the first row's time,
    which the trend counts from, is only known at the end.
    """
    y, x = or_default(F.col(score), 0).cast("double"), _hours(F.col(ts))
    timed = F.col(ts).isNotNull()
    return [
        F.regr_slope(y, x).alias("_slope"),
        F.avg(F.when(timed, x)).alias("_mean_hour"),
        F.avg(F.when(timed, y)).alias("_mean_score"),
        F.min(x).alias("_first_hour"),
        F.max(x).alias("_last_hour"),
        F.count(F.when(timed, 1)).alias("_timed"),
    ]


def trend_columns(asof: Column | None = None, least: int = fv.TREND_MIN_ROWS) -> list[Column]:
    """Trend of one row of `trend_aggregates`; flat below `least` rows or at one instant."""
    enough = F.col("_timed") >= least
    # On a single instant the slope is undefined; rounding must not make one up.
    spread = F.col("_last_hour") > F.col("_first_hour")
    slope = F.when(spread, F.coalesce(F.col("_slope"), F.lit(0.0))).otherwise(0.0)
    intercept = F.col("_mean_score") - slope * (F.col("_mean_hour") - F.col("_first_hour"))
    end = F.col("_last_hour") if asof is None else _hours(asof)
    following = slope * (end - F.col("_first_hour") + 1) + intercept
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), following))
    return [
        F.when(enough, F.round(slope, 3)).otherwise(0.0).alias("slope"),
        F.when(enough, F.round(intercept, 2)).otherwise(0.0).alias("intercept"),
        F.when(enough, F.round(clamped, 1)).alias("next_predicted"),
        F.when(enough, trend_word(slope)).otherwise("stable").alias("trend"),
        F.col("_timed").alias("data_points"),
    ]


def score_trend(
    events: DataFrame, score: str = "threat_score", ts: str = "ts", asof: Column | None = None
) -> DataFrame:
    """One row: slope per hour, intercept at the first event, prediction an hour after `asof`.

    `asof` defaults to the newest event. Cut the events with `latest` first where only the
    newest ones count.
    """
    return events.agg(*trend_aggregates(score, ts)).select(*trend_columns(asof))


# Moments of a bucket of time: hours are counted from the bucket's own start.
BUCKET_HOURS = 1
MOMENTS = (
    "bucket bigint, n bigint, x double, y double, xx double, xy double, first_hour double, last_hour double"
)


def bucket_of(ts: Column, hours: int = BUCKET_HOURS) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(3_600_000_000 * hours)).cast("bigint")


def bucket_moments(events: DataFrame, score: str = "threat_score", ts: str = "ts", hours: int = BUCKET_HOURS) -> DataFrame:
    """Count, sums and products of time and score per bucket; rows without a time have none.

    Moments of one bucket add up over batches, and a bucket that leaves a window is left out or
    subtracted. First and last hour are the least and greatest.
    """
    y = or_default(F.col(score), 0).cast("double").alias("y")
    at = bucket_of(F.col(ts), hours).alias("bucket")
    points = events.filter(F.col(ts).isNotNull()).select(at, _hours(F.col(ts)).alias("hour"), y)
    x = F.col("hour") - F.col("bucket") * hours
    return points.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(x).alias("x"),
        F.sum("y").alias("y"),
        F.sum(x * x).alias("xx"),
        F.sum(x * F.col("y")).alias("xy"),
        F.min("hour").alias("first_hour"),
        F.max("hour").alias("last_hour"),
    )


def trend_of_moments(moments: DataFrame, asof: Column | None = None, hours: int = BUCKET_HOURS) -> DataFrame:
    """`score_trend` of the rows behind some buckets' moments.

    All are shifted to one origin, the oldest bucket's start, so hours stay small and sums exact
    enough however long ago the epoch is.
    """
    first = F.min("bucket").over(Window.partitionBy())
    gap = ((F.col("bucket") - F.col("oldest")) * hours).cast("double")
    shifted = moments.withColumn("oldest", first).select(
        "oldest", "n", "y", "first_hour", "last_hour",
        (F.col("x") + gap * F.col("n")).alias("x"),
        (F.col("xx") + 2 * gap * F.col("x") + gap * gap * F.col("n")).alias("xx"),
        (F.col("xy") + gap * F.col("y")).alias("xy"),
    )
    total = shifted.agg(
        F.min("oldest").alias("oldest"), F.coalesce(F.sum("n"), F.lit(0)).alias("_timed"),
        *[F.sum(c).alias(c) for c in ("x", "y", "xx", "xy")],
        F.min("first_hour").alias("_first_hour"), F.max("last_hour").alias("_last_hour"),
    )
    n = F.nullif(F.col("_timed"), F.lit(0)).cast("double")
    spread = F.nullif(F.col("xx") - F.col("x") * F.col("x") / n, F.lit(0.0))
    return total.select(
        ((F.col("xy") - F.col("x") * F.col("y") / n) / spread).alias("_slope"),
        (F.col("oldest") * hours + F.col("x") / n).alias("_mean_hour"),
        (F.col("y") / n).alias("_mean_score"),
        "_first_hour", "_last_hour", "_timed",
    ).select(*trend_columns(asof))


def newest_buckets(moments: DataFrame, n: int) -> tuple[DataFrame, int | None, int]:
    """The buckets that lie wholly in the newest `n` rows, the next older one, and its rows that do too.

    Every bucket has a row, so the newest `n` buckets are enough to look at.
    """
    newest = moments.orderBy(F.desc("bucket")).limit(n)
    upto = F.sum("n").over(Window.orderBy(F.desc("bucket")))
    counted = newest.withColumn("upto", upto)
    edge = counted.filter(F.col("upto") > n).orderBy(F.desc("bucket")).select("bucket", n - (F.col("upto") - F.col("n"))).first()
    whole = counted.filter(F.col("upto") <= n).drop("upto")
    return (whole, edge[0], int(edge[1])) if edge else (whole, None, 0)
