"""Applying a fitted model to whole frames, with no job per row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import features as feature_columns
from wardline.functions import fixed_values as fv
from wardline.functions.literals import literal_map, literal_rows
from wardline.functions.rules import adjusted_score, or_default
from wardline.operators.training import ThreatModel, assembler, scaler



def add_features(records: DataFrame, kind: str = "ip") -> DataFrame:
    """Records with the eleven feature columns of an ip or an e-mail record.

    Records that have them already, as enriched signals do, are left as they are.
    """
    if set(fv.FEATURES) <= set(records.columns):
        return records
    builders = {"ip": feature_columns.ip_features, "email": feature_columns.email_features}
    return records.select("*", *builders[kind]())


def distance(vector: Sequence[Column], centre: Sequence[float]) -> Column:
    """Euclidean distance to a fixed centre, term by term so that it stays in codegen."""
    squares = [(x - F.lit(float(c))) * (x - F.lit(float(c))) for x, c in zip(vector, centre)]
    return F.sqrt(reduce(add, squares))


def elements(array: str) -> list[Column]:
    return [F.get(array, i) for i in range(len(fv.FEATURES))]


def nearest_centre(vector: Sequence[Column], centres) -> Column:
    """Struct of the distance to the nearest of a few fixed centres, and its id."""
    options = [
        F.struct(distance(vector, c).alias("distance"), F.lit(i).alias("id"))
        for i, c in enumerate(centres)
    ]
    return F.least(*options) if len(options) > 1 else options[0]


def distance_to_own(vector: Sequence[Column], cluster: Column, centres) -> Column:
    """Distance to the centre of the assigned cluster."""
    chosen = F.lit(None).cast("double")
    for i, centre in enumerate(centres):
        chosen = F.when(cluster == i, distance(vector, centre)).otherwise(chosen)
    return chosen


def is_anomaly(distance_column: Column) -> Column:
    return distance_column > fv.ANOMALY_DISTANCE


def scale_features(featured: DataFrame) -> DataFrame:
    """All rows with the standardised vector as an array column `scaled`."""
    assembled = assembler().transform(featured)
    scaled = scaler().fit(assembled).transform(assembled)
    return scaled.withColumn("scaled", vector_to_array("features"))


def risk_drivers(model: ThreatModel) -> Column:
    """The strongest features of the forest; the same for every row."""
    return F.array(
        *[
            F.struct(F.lit(name).alias("factor"), F.round(F.lit(weight * 100), 1).alias("weight"))
            for name, weight in model.importances[: fv.TOP_DRIVERS]
        ]
    )


def risk_driver_rows(spark: SparkSession, model: ThreatModel) -> DataFrame:
    """The same as rows, strongest first."""
    rows = [
        (rank, name, weight)
        for rank, (name, weight) in enumerate(model.importances[: fv.TOP_DRIVERS], 1)
    ]
    table = literal_rows(spark, "rank int, factor string, weight double", rows)
    return table.withColumn("weight", F.round(F.col("weight") * 100, 1))


def score_records(
    records: DataFrame, model: ThreatModel, kind: str = "ip", score: str = "threat_score"
) -> DataFrame:
    """Records with every model result; batch and streaming frames alike.

    All of it is one projection over the input: no shuffle, no job at call time.
    """
    columns = [c for c in records.columns if c not in fv.FEATURES]
    scored = model.pipeline.transform(add_features(records, kind))
    scored = scored.withColumn("_probability", vector_to_array("rf_probability"))
    scored = scored.withColumn("_scaled", vector_to_array("features"))
    own = distance_to_own(elements("_scaled"), F.col("cluster_id"), model.centres)
    scored = scored.withColumn("_distance", own)
    percent = F.transform("_probability", lambda p: F.round(p * 100, 1))
    labels = F.array(*[F.lit(label) for label in model.labels])
    name = F.coalesce(
        literal_map(model.cluster_names)[F.col("cluster_id")], F.lit(fv.UNKNOWN_CLUSTER)
    )
    raw = or_default(F.col(score), 0)
    return scored.select(
        *columns,
        F.lit(True).alias("ml_ready"),
        is_anomaly(F.col("_distance")).alias("anomaly"),
        F.round("_distance", 4).alias("anomaly_score"),
        "rf_prediction",
        F.round(F.array_max("_probability") * 100, 1).alias("rf_confidence"),
        F.map_from_arrays(labels, percent).alias("rf_probabilities"),
        "cluster_id",
        name.alias("cluster_name"),
        risk_drivers(model).alias("risk_drivers"),
        adjusted_score(raw, F.col("rf_prediction")).alias("ml_adjusted_score"),
    )
