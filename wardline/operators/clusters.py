"""Two-way split of events by raw score: the exact one-dimensional two-means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions.rules import or_default
from wardline.operators.recent import latest

SPLITS = 2
# A step through the bins: events and score sum so far, the best gain and the score it cuts at.
_STEP = "struct<n: double, x: double, gain: double, cut: double>"


def best_cut(bins: Column, n: Column, x: Column) -> Column:
    """The score up to which events form the lower part, from bins (score, n) by ascending score.

    In one dimension both parts of the best split are runs of the sorted scores, so prefix sums give
    every candidate: the squared distance it saves is (x1 n2 - x2 n1)^2 / (n1 n2) over n. The lowest
    of equally good cuts counts. A single score has no cut: null.
    """

    def step(state: Column, bin_: Column) -> Column:
        n1, x1 = state["n"] + bin_["n"], state["x"] + bin_["score"] * bin_["n"]
        n2, x2 = n - n1, x - x1
        gap = x1 * n2 - x2 * n1
        gain = F.when(n2 > 0, gap * gap / (n1 * n2))
        better = F.coalesce(gain > state["gain"], F.lit(False))
        return F.struct(
            n1.alias("n"),
            x1.alias("x"),
            F.when(better, gain).otherwise(state["gain"]).alias("gain"),
            F.when(better, bin_["score"]).otherwise(state["cut"]).alias("cut"),
        ).cast(_STEP)

    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("x"), F.lit(-1.0).alias("gain"), F.lit(None).cast("double").alias("cut"))
    return F.aggregate(bins, start.cast(_STEP), step, lambda state: state["cut"])


def score_cut(scored: DataFrame) -> DataFrame:
    """One row: `cut` (see `best_cut`) and `seen`, the number of rows, of a frame with a `score`.

    Scores are whole numbers of 0..100, so the histogram that is listed in one row has about a
    hundred bins however many events there are.
    """
    counts = scored.groupBy("score").agg(F.count(F.lit(1)).cast("double").alias("n"))
    bins = F.sort_array(F.collect_list(F.struct("score", "n")))
    listed = counts.agg(bins.alias("bins"), F.sum("n").alias("n"), F.sum(F.col("score") * F.col("n")).alias("x"))
    cut = best_cut(F.col("bins"), F.col("n"), F.col("x")).alias("cut")
    return listed.select(cut, F.coalesce(F.col("n"), F.lit(0.0)).cast("bigint").alias("seen"))


def split_by_score(
    events: DataFrame,
    n: int | None = fv.SPLIT_ROWS,
    score: str = "threat_score",
    id_column: str = "id",
) -> DataFrame:
    """Rows of (cluster, id, score); none when there are fewer than five events.

    Cluster 0 is the one with the lower scores. The cut is a scalar subquery over the histogram, so
    the split is a lazy frame: one pass for the cut, one for the rows.
    """
    value = or_default(F.col(score), 0).cast("double")
    scored = latest(events, n).select(F.col(id_column).alias("id"), value.alias("score"))
    found = score_cut(scored)
    cut, seen = found.select("cut").scalar(), found.select("seen").scalar()
    above = F.coalesce(F.col("score") > cut, F.lit(False)).cast("int")
    return scored.filter(seen >= fv.SPLIT_MIN_ROWS).select(above.alias("cluster"), "id", "score")

