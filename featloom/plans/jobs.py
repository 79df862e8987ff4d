"""The jobs, handing over by stored tables: text to collection, collection to
cleaned Parquet, Parquet to predictions and model, predictions to collection.

Every job replaces its output, so it can be run again after a failure.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from featloom.operators.clean import clean
from featloom.operators.cluster import (
    cluster_sizes,
    fit_model,
    model_centers,
    predict,
    result_columns,
    save_model,
)
from featloom.operators.features import model_scaler, standardise
from featloom.operators.ids import dense_ids, number_stored_rows
from featloom.operators.points import build_points
from featloom.operators.silhouette import silhouette
from featloom.sources.collection import CollectionInfo, CollectionStore
from featloom.sources.delimited import load_features
from featloom.sources.parquet import read_parquet, write_counted
from featloom.specs import PipelineSpec

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ClusterResult:
    predictions: DataFrame
    model: PipelineModel
    centers: DataFrame
    sizes: DataFrame
    silhouette: float


@dataclass(frozen=True)
class RunResult:
    ingested: CollectionInfo
    preprocessed: DataFrame
    clusters: ClusterResult
    published: CollectionInfo


def ingest(spark: SparkSession, spec: PipelineSpec) -> CollectionInfo:
    """Delimited text to the input collection, in one pass over the text."""
    columns, carried = spec.clean.columns, spec.clean.passthrough
    rows = load_features(spark, spec.source_path, columns, spec.separator, carried)
    store = CollectionStore(spark, spec.collections.root)
    name = spec.collections.input_name
    with store.staging(name) as path:
        points = build_points(dense_ids(rows, path, together=True), columns, passthrough=carried)
        info = store.recreate(
            name, len(columns), spec.collections.distance, points, together=True
        )
    log.info("%s: %d rows ingested", name, info.points_count)
    return info


def preprocess(spark: SparkSession, spec: PipelineSpec) -> DataFrame:
    """Input collection to cleaned Parquet; returns the stored table.

    The row count before comes from the collection, the one after is observed as the
    rows are written, so the collection is read twice: for the bounds and the result.
    """
    collection = CollectionStore(spark, spec.collections.root).open(spec.collections.input_name)
    raw = collection.scan(spec.clean.columns, passthrough=spec.clean.passthrough)
    written = write_counted(clean(raw, spec.clean), spec.preprocessed_path)
    log.info("%d rows, %d after cleaning", collection.info.points_count, written)
    return read_parquet(spark, spec.preprocessed_path)


def cluster(spark: SparkSession, spec: PipelineSpec) -> ClusterResult:
    """Cleaned Parquet to predictions and saved model.

    The source is narrow and stored by columns, so it is scanned again for
    scaler, fit and output rather than kept. The score is taken from the stored
    labels, scaled by plain column arithmetic.
    """
    columns, settings = spec.clean.columns, spec.cluster
    source = read_parquet(spark, spec.preprocessed_path)
    model = fit_model(source, columns, settings)
    predictions = predict(source, model)
    result = result_columns(predictions, columns, settings.prediction_col, settings.passthrough)
    written = write_counted(result, spec.predictions_path)
    save_model(model, spec.model_path)
    stored = read_parquet(spark, spec.predictions_path)
    scaled = standardise(stored, model_scaler(model, columns), "_scaled")
    score = silhouette(
        scaled, [f"{c}_scaled" for c in columns], settings.prediction_col
    ).first()["silhouette"]
    log.info("%d rows clustered, silhouette %.4f", written, score)
    return ClusterResult(
        predictions=stored,
        model=model,
        centers=model_centers(spark, model),
        sizes=cluster_sizes(stored, settings.prediction_col),
        silhouette=score,
    )


def publish(spark: SparkSession, spec: PipelineSpec) -> CollectionInfo:
    """Predictions to the output collection. The rows are numbered where they
    are stored, so this is a scan and a write, with a shuffle by id between them if
    there are more rows than a task is to sort."""
    columns, settings = spec.clean.columns, spec.cluster
    tier = spec.clean.tier.output if spec.clean.tier else ""
    numbered = number_stored_rows(spark, spec.predictions_path, together=True)
    points = build_points(
        numbered, columns, tier, settings.prediction_col, passthrough=settings.passthrough
    )
    store = CollectionStore(spark, spec.collections.root)
    info = store.recreate(
        spec.collections.output_name,
        len(columns),
        spec.collections.distance,
        points,
        together=True,
    )
    log.info("%s: %d rows published", info.name, info.points_count)
    return info


_MODES = {
    "upload": ingest,
    "preprocess": preprocess,
    "cluster": cluster,
    "write-results": publish,
}


MODES = (*_MODES, "all")


def run_mode(spark: SparkSession, mode: str | None, spec: PipelineSpec):
    """One job by name; without a name, or with an unknown one, preprocess."""
    return _MODES.get(mode, preprocess)(spark, spec)


def run_all(spark: SparkSession, spec: PipelineSpec) -> RunResult:
    """All jobs in order. Text is ingested only if the input collection is
    missing or empty."""
    store = CollectionStore(spark, spec.collections.root)
    if store.has_data(spec.collections.input_name):
        ingested = store.info(spec.collections.input_name)
    else:
        ingested = ingest(spark, spec)
    return RunResult(
        ingested=ingested,
        preprocessed=preprocess(spark, spec),
        clusters=cluster(spark, spec),
        published=publish(spark, spec),
    )
