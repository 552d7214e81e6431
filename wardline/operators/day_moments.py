"""Mean and spread of features from daily moments that merge in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.rules import or_default

# A deviation of less than this part of the mean is none.
ROUNDING = 1e-9


def day_moments(rows: DataFrame, features: list[str], ts: str = "ts") -> DataFrame:
    """(day, feature, n, mean, m2): count, mean and sum of squared distances from it, per day.

    Rows without a time count as a day of their own (null).
    """
    values = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    listed = rows.select(F.col(ts).cast("date").alias("day"), F.inline(values)).filter("value is not null")
    n = F.count("value")
    return listed.groupBy("day", "feature").agg(
        n.alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * n).alias("m2")
    )


def merge_moments(moments: DataFrame) -> DataFrame:
    """(feature, n, mean, m2) of all rows behind moments of several days.

    The distance of each day's mean from the common one is added to its own squares, so nothing
    cancels: the figures are those of one pass over the rows.
    """
    total = moments.groupBy("feature").agg(F.sum("n").alias("all_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("all_mean"))
    gap = F.col("mean") - F.col("all_mean")
    # One row per feature.
    joined = moments.join(F.broadcast(total), "feature")
    return joined.groupBy("feature").agg(
        F.max("all_n").alias("n"), F.max("all_mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * gap * gap).alias("m2")
    )


def scale_by(rows: DataFrame, merged: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """`keep` and each feature less its mean, over its sample deviation; 0 where that is 0."""
    deviation = F.sqrt(F.col("m2") / (F.col("n") - 1)).alias("sd")
    each = [F.max(F.when(F.col("feature") == f, F.struct("mean", deviation))).alias(f) for f in features]
    # One row, whatever the input.
    figures = merged.agg(F.struct(*each).alias("figures")).scalar()

    def scaled(f):
        mean, sd = (figures.getField(f).getField(x) for x in ("mean", "sd"))
        # Merged means differ from a constant by rounding only.
        constant = or_default(sd, 0.0) <= ROUNDING * F.abs(mean)
        return F.when(constant, 0.0).otherwise((F.col(f) - mean) / sd).alias(f)

    return rows.select(*keep, *map(scaled, features))
