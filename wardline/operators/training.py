"""Training set, model fit, save and load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import fixed_values as fv
from wardline.functions.literals import literal_map
from wardline.functions.rules import score_to_level
from wardline.sources.store import stage

# Fit partitions: small ones up to SMALL_FIT of them, then large ones, so that a small fit
# is spread over cores and a huge one does not drown in tasks.
SMALL_PARTITION, SMALL_FIT, LARGE_PARTITION = 10_000, 64, 1_000_000


def assembler() -> VectorAssembler:
    return VectorAssembler(
        inputCols=list(fv.FEATURES), outputCol="raw_features", handleInvalid="error"
    )


def scaler() -> StandardScaler:
    return StandardScaler(
        inputCol="raw_features", outputCol="features", withMean=True, withStd=True
    )


def label_indexer() -> StringIndexer:
    return StringIndexer(inputCol="label_str", outputCol="label")


def training_set(features: DataFrame, score: str = "threat_score") -> DataFrame:
    """Feature rows labelled by their score band."""
    return features.withColumn("label_str", score_to_level(F.col(score)))


def with_mix_weights(labelled: DataFrame, mix: dict[str, float] | None = None) -> DataFrame:
    """Row weights that give the labels the shares in `mix`; no row is dropped or repeated."""
    mix = mix or fv.TRAINING_MIX
    known = labelled.filter(F.col("label_str").isin(*fv.LEVELS))
    # At most one row per level comes to the driver.
    counts = {row[0]: row[1] for row in known.groupBy("label_str").count().collect()}
    total = sum(counts.values())
    weights = {level: mix.get(level, 0.0) * total / n for level, n in counts.items()}
    weight = literal_map(weights)[F.col("label_str")] if weights else F.lit(None)
    return labelled.withColumn("weight", F.coalesce(weight, F.lit(0.0)))


def in_stable_order(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Even partitions whose number and content depend on the data alone.

    Tree bagging and k-means seeding follow partition and row order, so without this the
    same rows give other models on another cluster.
    """
    partitions = max(min(rows // SMALL_PARTITION + 1, SMALL_FIT), rows // LARGE_PARTITION + 1)
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def label_counts(labelled: DataFrame) -> DataFrame:
    """Rows per label with the label's index by frequency."""
    indexed = label_indexer().fit(labelled).transform(labelled)
    return indexed.groupBy("label_str", F.col("label").cast("int").alias("label_index")).agg(
        F.count(F.lit(1)).alias("n")
    )


def fit_kmeans(staged: DataFrame, k: int, keys: list[str], prediction: str):
    """k-means over staged distinct vectors with the column `weight` for their counts: the
    same objective as over all rows, on far fewer of them."""
    estimator = KMeans(
        featuresCol="features", predictionCol=prediction, weightCol="weight", k=k, seed=fv.SEED
    )
    return estimator.fit(in_stable_order(staged, keys, staged.count()))


@dataclass
class ThreatModel:
    """Fitted stages in scoring order: assemble, scale, forest, label text, clusters.

    There is no label-index stage, so rows without a label can be scored.
    """

    pipeline: PipelineModel
    naming: str = "by_rank"

    @property
    def scaler(self):
        return self.pipeline.stages[1]

    @property
    def forest(self):
        return self.pipeline.stages[2]

    @property
    def labels(self) -> list[str]:
        return self.pipeline.stages[3].getLabels()

    @property
    def kmeans(self):
        return self.pipeline.stages[4]

    @property
    def centres(self) -> list[list[float]]:
        return [[float(x) for x in centre] for centre in self.kmeans.clusterCenters()]

    @property
    def cluster_names(self) -> dict[int, str]:
        """Name per cluster id: by falling score of the centre, or by the bare id."""
        ids = range(len(self.centres))
        if self.naming == "by_rank":
            ids = sorted(ids, key=lambda i: -self.centres[i][0])
        return dict(zip(ids, fv.CLUSTER_NAMES))

    @property
    def importances(self) -> list[tuple[str, float]]:
        """All features by falling importance, ties in vector order."""
        weights = [float(w) for w in self.forest.featureImportances.toArray()]
        return sorted(zip(fv.FEATURES, weights), key=lambda pair: -pair[1])

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, naming: str = "by_rank") -> ThreatModel:
        return cls(PipelineModel.read().session(spark).load(path), naming)


def fit_model(
    labelled: DataFrame,
    id_column: str = "id",
    naming: str = "by_rank",
    weight: str | None = None,
) -> ThreatModel:
    """Fit scaler, forest and clusters on labelled feature rows.

    The rows are staged once on shared storage: every fit passes over them several times,
    and a lost executor then costs a re-read, not the joins behind the features. The forest, too, is
    trained on all of them.
    """
    extra = [weight] if weight else []
    kept = labelled.select(id_column, *fv.FEATURES, "label_str", *extra)
    staged = stage(kept, "training")
    assembled = assembler().transform(staged)
    scale = scaler().fit(assembled)
    index = label_indexer().fit(staged)

    ordered = in_stable_order(staged, [id_column], staged.count())
    prepared = index.transform(scale.transform(assembler().transform(ordered)))
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        predictionCol="rf_index",
        probabilityCol="rf_probability",
        rawPredictionCol="rf_raw",
        numTrees=fv.FOREST_TREES,
        maxDepth=fv.FOREST_DEPTH,
        seed=fv.SEED,
    )
    if weight:
        forest = forest.setWeightCol(weight)
    forest_model = forest.fit(prepared)
    to_label = IndexToString(inputCol="rf_index", outputCol="rf_prediction", labels=index.labels)

    # Unrelated to class weights: how often a vector occurs.
    vectors = staged.groupBy(*fv.FEATURES).agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )
    distinct = stage(vectors, "vectors")
    scaled = scale.transform(assembler().transform(distinct))
    kmeans_model = fit_kmeans(scaled, fv.CLUSTERS, list(fv.FEATURES), "cluster_id")

    stages = [assembler(), scale, forest_model, to_label, kmeans_model]
    return ThreatModel(PipelineModel(stages), naming)
