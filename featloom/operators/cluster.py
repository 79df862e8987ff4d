"""K-Means: fit, assign, centres, sizes, cost, score."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, SparkSession, functions as F

from featloom.functions.vectors import (
    Centers,
    feature_array,
    index_of_smallest,
    nearest_in_batches,
    present,
    squared_distances,
    written_out,
)
from featloom.operators.features import fit_features
from featloom.sources.local import small_table
from featloom.specs import ClusterSpec


# What the estimator keeps of a partition, and reads again in each iteration, at 8 bytes
# a value and some per row: little while few partitions do, bounded at any size. Up to
# 200 partitions a shuffle is written without keeping its rows in memory.
_ROW_BYTES = 96
_KEPT_BYTES = 16 << 20
_MOST_KEPT_BYTES = 192 << 20
_FEW_PARTITIONS = 192


def _bounded(rows: DataFrame, values: int) -> DataFrame:
    """The rows as they are stored or, if there are more than a small partition
    holds, dealt evenly to as many partitions as they need. The number follows from
    the rows and ``values`` per row, never from the cluster. Sorted by where they
    were read, they are the same in each partition whenever it is computed."""
    size = rows.count() * (_ROW_BYTES + 8 * values)
    parts = max(min(math.ceil(size / _KEPT_BYTES), _FEW_PARTITIONS), math.ceil(size / _MOST_KEPT_BYTES))
    if parts <= 1:
        return rows
    placed = rows.withColumn("_position", F.monotonically_increasing_id())
    return placed.repartition(parts, "_position").sortWithinPartitions("_position").drop("_position")


def fit_kmeans(scaled: DataFrame, spec: ClusterSpec) -> KMeansModel:
    """Fit on the scaled vector column. The estimator keeps the vectors, and
    only them, in memory or on disk for its iterations; do not persist the
    input as well. Many rows are dealt to partitions of bounded size first."""
    vectors = scaled.select(spec.scaled_features_col)
    one = vectors.first()
    return _fit(_bounded(vectors, one[0].size if one and one[0] is not None else 0), spec)


def _fit(scaled: DataFrame, spec: ClusterSpec) -> KMeansModel:
    return KMeans(
        k=spec.k,
        seed=spec.seed,
        maxIter=spec.max_iter,
        tol=spec.tol,
        featuresCol=spec.scaled_features_col,
        predictionCol=spec.prediction_col,
    ).fit(scaled.select(spec.scaled_features_col))


def fit_model(df: DataFrame, columns: Sequence[str], spec: ClusterSpec) -> PipelineModel:
    """Scaler and clusters fitted on the columns, as one model, in as many
    partitions as ``spec`` says; otherwise as stored or, if there are many rows, in
    partitions of bounded size."""
    features = fit_features(
        df,
        columns,
        features_col=spec.features_col,
        scaled_features_col=spec.scaled_features_col,
    )
    # The plain columns are what moves, not the vectors made of them.
    rows = df.select(*columns)
    rows = rows.repartition(spec.partitions) if spec.partitions else _bounded(rows, len(columns))
    return join_models(features, _fit(features.transform(rows), spec))


def join_models(features: PipelineModel, kmeans: KMeansModel) -> PipelineModel:
    """Scaler and clusters as one model, so new rows are scaled as the old were."""
    return PipelineModel(stages=[*features.stages, kmeans])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(df: DataFrame, model: PipelineModel | KMeansModel) -> DataFrame:
    return model.transform(df)


def model_centers(spark: SparkSession, model: PipelineModel | KMeansModel) -> DataFrame:
    """The fitted centres, k rows of (cluster, center)."""
    kmeans = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(kmeans.clusterCenters())]
    return small_table(spark, {"cluster": "int", "center": "array<double>"}, rows)


def evaluate(
    predictions: DataFrame,
    features_col: str = "scaled_features",
    prediction_col: str = "prediction",
    metric: str = "silhouette",
) -> float:
    """Score of a clustering over its vector column."""
    return ClusteringEvaluator(
        featuresCol=features_col, predictionCol=prediction_col, metricName=metric
    ).evaluate(predictions)


def cluster_sizes(predictions: DataFrame, prediction_col: str = "prediction") -> DataFrame:
    """Rows per cluster, in order of the label. Counts are combined before the
    shuffle, so a cluster that holds most rows costs no more than any other."""
    return (
        predictions.groupBy(prediction_col)
        .agg(F.count("*").alias("cluster_size"))
        .orderBy(prediction_col)
    )


def result_columns(
    predictions: DataFrame,
    columns: Sequence[str],
    prediction_col: str = "prediction",
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """What is stored of a clustering: features and label, plus what is carried."""
    carried = [c for c in passthrough if c not in columns]
    return predictions.select(*columns, *carried, prediction_col)


def assign_nearest(
    df: DataFrame, columns: Sequence[str], centers: Centers, output: str = "prediction"
) -> DataFrame:
    """Label each row with its nearest given centre, by scalar columns; null if
    one of them is missing."""
    if not written_out(columns, centers):
        return df.withColumn(output, nearest_in_batches(feature_array(columns), centers)["cluster"])
    distances = df.withColumn("_distances", squared_distances(columns, centers))
    label = F.when(present(columns), index_of_smallest("_distances"))
    return distances.withColumn(output, label).drop("_distances")


def assign_nearest_array(
    df: DataFrame, vector_col: str, centers: Centers, output: str = "prediction"
) -> DataFrame:
    """Label each row with its nearest given centre, by an array column."""
    return df.withColumn(output, nearest_in_batches(F.col(vector_col), centers)["cluster"])


def centers_of(
    predictions: DataFrame, columns: Sequence[str], prediction_col: str = "prediction"
) -> DataFrame:
    """Mean of each column per cluster: the centres that belong to a labelling."""
    return predictions.groupBy(prediction_col).agg(*[F.avg(c).alias(c) for c in columns])


def lloyd_step(df: DataFrame, columns: Sequence[str], centers: Centers) -> DataFrame:
    """One iteration of K-Means from given centres: new centre and size per cluster."""
    labelled = assign_nearest(df.select(*columns), columns, centers, "cluster")
    return labelled.groupBy("cluster").agg(
        F.count("*").alias("cluster_size"), *[F.avg(c).alias(c) for c in columns]
    )


@dataclass(frozen=True)
class KeyedFit:
    centers: list[list[float]]
    sizes: list[int]  # rows of each in the last round
    rounds: int
    settled: bool  # whether the last round moved no centre


# Sums of coordinates are taken of whole multiples of 2**-20, so that they do not depend
# on the order they are added up in. Coordinates may be up to 2**42.
_STEPS_PER_UNIT = float(1 << 20)


def keyed_seeds(df: DataFrame, columns: Sequence[str], k: int, key: Sequence[str]) -> list[list[float]]:
    """``k`` rows without missing values, drawn by a hash of the key: the same ones
    however the rows are partitioned. Rows of equal hash go by their values."""
    drawn = F.md5(F.concat_ws("/", *[F.col(c).cast("string") for c in key]).cast("binary"))
    values = [F.col(c).cast("double").alias(c) for c in columns]
    rows = df.where(present(columns)).select(drawn.alias("_hash"), *values).orderBy("_hash", *columns).limit(k).collect()
    if len(rows) < k:
        raise ValueError(f"{len(rows)} rows without missing values for {k} clusters")
    return [[r[c] for c in columns] for r in rows]


def fit_keyed(
    df: DataFrame, columns: Sequence[str], k: int, key: Sequence[str], max_rounds: int = 20
) -> KeyedFit:
    """K-Means that does not depend on how the rows are partitioned, unlike the
    estimator: seeds drawn by key, then Lloyd rounds with exact sums, until no centre
    moves or ``max_rounds`` are done. A centre that no row is nearest to stays where it
    is. A round is one aggregate; a row per cluster comes to the driver."""
    centers, sizes, rounds, settled = keyed_seeds(df, columns, k, key), [0] * k, 0, False
    while rounds < max_rounds and not settled:
        labelled = assign_nearest(df.select(*columns), columns, centers, "cluster")
        steps = [F.floor(F.col(c) * _STEPS_PER_UNIT + 0.5).cast("decimal(20,0)") for c in columns]
        sums = labelled.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(s).alias(f"s{i}") for i, s in enumerate(steps)])
        found = {r["cluster"]: r for r in sums.collect() if r["cluster"] is not None}
        moved = [
            [float(int(found[j][f"s{i}"])) / (found[j]["n"] * _STEPS_PER_UNIT) for i in range(len(columns))]
            if j in found else center
            for j, center in enumerate(centers)
        ]
        sizes = [found[j]["n"] if j in found else 0 for j in range(k)]
        settled, centers, rounds = moved == centers, moved, rounds + 1
    return KeyedFit(centers, sizes, rounds, settled)


def within_cluster_cost(df: DataFrame, columns: Sequence[str], centers: Centers) -> DataFrame:
    """Sum of squared distances of all rows without missing values to their nearest
    centre, one row."""
    if written_out(columns, centers):
        smallest = F.when(present(columns), F.array_min(squared_distances(columns, centers)))
    else:
        smallest = nearest_in_batches(feature_array(columns), centers)["distance"]
    return df.agg(F.sum(smallest).alias("cost"))
