"""

``queries()`` runs each operator over whole tables; ``oracle_sql()`` says the
same in SQL. A K-Means fit depends on how rows are partitioned, so what is compared
of it is what must hold of any fit.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from featloom.functions.casts import feature_schema, to_double
from featloom.functions.tiers import tier
from featloom.functions.vectors import nearest_in_batches, squared_distance, squared_distances
from featloom.operators import clean as cleaning
from featloom.operators import cluster as clustering
from featloom.operators.features import (
    assemble,
    assemble_array,
    fit_features,
    scaler_stats,
    scaler_values,
    standardise,
)
from featloom.operators.ids import dense_ids
from featloom.operators.points import batch_counts, build_points
from featloom.operators.quantiles import quantile_bounds
from featloom.operators.silhouette import silhouette
from featloom.plans.jobs import run_all, run_mode
from featloom.sources.collection import CollectionStore
from featloom.sources.delimited import load_features, read_delimited
from featloom.sources.local import small_table
from featloom.sources.parquet import read_parquet, write_parquet
from featloom.sources.scratch import scratch_path
from featloom.specs import (
    BandSpec,
    CleanSpec,
    ClusterSpec,
    CollectionSpec,
    PipelineSpec,
    TierSpec,
)
from oracle import ORACLE

# The subpackage for training data, and the pipeline made of it, are optional.
try:
    import corpus_pipeline
    from featloom.llm import queries as llm
except ImportError as error:
    if error.name != "corpus_pipeline" and not (error.name or "").startswith("featloom.llm"):
        raise
    corpus_pipeline = llm = None

SMALL = "/root/testdata/sf0.001"

# The feature table of most queries, and the columns that identify its rows.
FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
ROW_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
KEYS = tuple(c for c in ROW_KEY if c not in FEATURES)
# Three of these bounds equal the largest value, so that < and <= differ.
UPPER = {"l_quantity": 50.0, "l_extendedprice": 100000.0, "l_discount": 0.1, "l_tax": 0.08}
EXACT_BAND = BandSpec(relative_error=0.0)
PRICE_TIER = TierSpec("l_extendedprice", 20000.0, 70000.0, "price_tier")
CHAIN = CleanSpec(
    columns=FEATURES,
    upper_bounds=UPPER,
    band=EXACT_BAND,
    tier=PRICE_TIER,
    row_limit=None,
    order_by=ROW_KEY,
    passthrough=KEYS,
)
SCALED = tuple(f"{c}_scaled" for c in FEATURES)
RAW_CENTERS = (
    (10.0, 15000.0, 0.05, 0.04),
    (20.0, 30000.0, 0.05, 0.04),
    (30.0, 45000.0, 0.05, 0.04),
    (40.0, 60000.0, 0.05, 0.04),
    (45.0, 80000.0, 0.05, 0.04),
)
SCALED_CENTERS = (
    (-1.0, -1.0, 0.5, 0.0),
    (-1.0, 1.0, 0.0, 0.5),
    (1.0, -1.0, -0.5, 0.0),
    (1.0, 1.0, 0.0, -0.5),
    (0.0, 0.0, 0.0, 0.0),
)
PART_COLUMNS = ("p_size", "p_retailprice")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


def _gaps(rows: DataFrame) -> DataFrame:
    """``rows`` of lineitem with nulls, NaN and negative values in the features."""
    return rows.withColumns(
        {
            "l_discount": F.nullif("l_discount", F.lit(0.0)),
            "l_tax": F.when(F.col("l_tax") == 0.01, float("nan")).otherwise(F.col("l_tax")),
            "l_quantity": F.when(F.col("l_quantity") == 13, -13.0).otherwise(F.col("l_quantity")),
        }
    )


def _rounded(columns: Sequence[str], digits: int = 4) -> list[Column]:
    return [F.round(c, digits).alias(c) for c in columns]


# --- cleaning -------------------------------------------------------------


def select_features(spark, sf_dir):
    return cleaning.select_features(_lineitem(spark, sf_dir), FEATURES)


def drop_missing(spark, sf_dir):
    rows = _lineitem(spark, sf_dir).select(
        *ROW_KEY,
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_tax") == 0.01, float("nan")).otherwise(F.col("l_tax")).alias("l_tax"),
    )
    return cleaning.drop_missing(rows, ["l_discount", "l_tax"])


def non_negative(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return cleaning.keep_non_negative(customers, ["c_acctbal"])


def upper_bounds(spark, sf_dir):
    rows = _lineitem(spark, sf_dir).select(*KEYS, *FEATURES)
    return cleaning.keep_below(rows, UPPER)


def _bounds_frame(spark, bounds) -> DataFrame:
    # Adding zero turns the negative zero of some rows into plain zero.
    rows = [(c, low + 0.0, high + 0.0) for c, (low, high) in bounds.items()]
    fields = {"column_name": "string", "lower": "double", "upper": "double"}
    return small_table(spark, fields, rows)


def _quantile_bounds(band: BandSpec):
    def run(spark, sf_dir):
        return _bounds_frame(spark, quantile_bounds(_lineitem(spark, sf_dir), FEATURES, band))

    return run


def quantile_rank_error(spark, sf_dir):
    """Whether approximate bounds lie within the rank error asked for."""
    rows = _lineitem(spark, sf_dir)
    band = BandSpec(relative_error=0.001)
    checks = []
    for c, ends in quantile_bounds(rows, FEATURES, band).items():
        for end, p, value in zip(("lower", "upper"), (band.lower, band.upper), ends):
            # The value holds all ranks from the rows below it to those up to it.
            allowed = F.count("*") * band.relative_error + 1
            low_enough = F.count_if(F.col(c) < value) <= F.count("*") * p + allowed
            high_enough = F.count_if(F.col(c) <= value) >= F.count("*") * p - allowed
            checks.append(
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(end).alias("bound"),
                    F.count("*").alias("n_rows"),
                    (low_enough & high_enough).alias("within_error"),
                )
            )
    return rows.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


def _quantile_band(band: BandSpec):
    def run(spark, sf_dir):
        rows = _lineitem(spark, sf_dir).select(*KEYS, *FEATURES)
        return cleaning.keep_within(rows, quantile_bounds(rows, FEATURES, band))

    return run


def limit_keyed(spark, sf_dir):
    rows = _lineitem(spark, sf_dir).select(*KEYS, *FEATURES)
    return cleaning.limit_rows(rows, 1000, ROW_KEY)


def tier_bucket(spark, sf_dir):
    spec = TierSpec("value", output="tier")
    return cleaning.add_tier(_table(spark, sf_dir, "events").select("event_id", "value"), spec)


def tier_counts(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return clustering.cluster_sizes(events.select(tier(TierSpec("value", output="tier"))), "tier")


def preprocess_chain(spark, sf_dir):
    return cleaning.clean(_gaps(_lineitem(spark, sf_dir)), replace(CHAIN, row_limit=1000))


def preprocess_chain_whole(spark, sf_dir):
    return cleaning.clean(_gaps(_lineitem(spark, sf_dir)), CHAIN)


def preprocess_chain_default_band(spark, sf_dir):
    return cleaning.clean(_gaps(_lineitem(spark, sf_dir)), replace(CHAIN, band=BandSpec()))


def stage_funnel(spark, sf_dir):
    rows = _gaps(_lineitem(spark, sf_dir))
    fixed = cleaning.clean_fixed(rows, CHAIN)
    bounds = quantile_bounds(fixed, FEATURES, EXACT_BAND)
    return cleaning.stage_counts(rows, CHAIN, bounds)


# --- text and Parquet -----------------------------------------------------


def _part_text(spark, sf_dir) -> str:
    """The part table as tab-separated text, with some sizes made unreadable."""
    path = scratch_path(spark, "part-text")
    size = F.when(F.col("p_size") > 40, "n/a").otherwise(F.col("p_size").cast("string"))
    parts = _table(spark, sf_dir, "part").withColumn("p_size", size)
    parts.write.options(header=True, sep="\t").csv(path)
    return path


def csv_scan(spark, sf_dir):
    """All columns with their types inferred."""
    return read_delimited(spark, _part_text(spark, sf_dir), infer_types=True).select(
        F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", "p_size", "p_retailprice"
    )


def csv_feature_load(spark, sf_dir):
    text = _part_text(spark, sf_dir)
    return load_features(spark, text, PART_COLUMNS, passthrough=["p_name"])


def safe_cast(spark, sf_dir):
    """Texts of every kind made from part names and sizes, as numbers."""
    size = F.col("p_size").cast("string")
    text = (
        F.when(F.col("p_size") <= 10, F.col("p_name"))
        .when(F.col("p_size") <= 20, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(F.col("p_size") <= 35, F.concat(size, F.lit("e1")))
        .otherwise(F.lit(""))
    )
    return _table(spark, sf_dir, "part").select("p_partkey", to_double(text).alias("number"))


def payload_schema(spark, sf_dir):
    """Part numbers read back with the nullable double schema of the features."""
    path = scratch_path(spark, "part-numbers")
    parts = _table(spark, sf_dir, "part").select(*[to_double(c).alias(c) for c in PART_COLUMNS])
    write_parquet(parts, path)
    return spark.read.schema(feature_schema(PART_COLUMNS)).parquet(path)


def parquet_round_trip(spark, sf_dir):
    path = scratch_path(spark, "part")
    write_parquet(_table(spark, sf_dir, "part"), path)
    write_parquet(_table(spark, sf_dir, "part"), path)
    return read_parquet(spark, path)


# --- features and clusters ------------------------------------------------


def _vector_columns(df: DataFrame, vector: Column, names: Sequence[str]) -> DataFrame:
    values = df.withColumn("_v", vector)
    return values.select(*ROW_KEY, *[F.col("_v")[i].alias(c) for i, c in enumerate(names)])


VECTOR_NAMES = ("v0", "v1", "v2", "v3")


def assemble_vector(spark, sf_dir):
    rows = assemble(_lineitem(spark, sf_dir), FEATURES)
    return _vector_columns(rows, vector_to_array("features"), VECTOR_NAMES)


def assemble_as_array(spark, sf_dir):
    rows = assemble_array(_lineitem(spark, sf_dir), FEATURES)
    return _vector_columns(rows, F.col("features"), VECTOR_NAMES)


def scaler_statistics(spark, sf_dir):
    return scaler_stats(_lineitem(spark, sf_dir), FEATURES).select(
        "column_name", *_rounded(["mean", "std"])
    )


def _scaled(spark, sf_dir) -> DataFrame:
    rows = _lineitem(spark, sf_dir).select(*KEYS, *FEATURES)
    return standardise(rows, scaler_values(rows, FEATURES))


def standardise_columns(spark, sf_dir):
    return _scaled(spark, sf_dir).select(*ROW_KEY, *_rounded(SCALED))


def feature_build(spark, sf_dir):
    rows = _lineitem(spark, sf_dir).select(*KEYS, *FEATURES)
    built = fit_features(rows, FEATURES).transform(rows)
    scaled = _vector_columns(built, vector_to_array("scaled_features"), SCALED)
    return scaled.select(*ROW_KEY, *_rounded(SCALED))


def constant_column(spark, sf_dir):
    """Scaling where a column has no spread: zero in both forms, and a missing
    value stays missing in the column form."""
    columns = ("l_quantity", "constant")
    rows = _lineitem(spark, sf_dir).select(
        *ROW_KEY,
        "l_quantity",
        F.lit(5.0).alias("constant"),
        F.when(F.col("l_linenumber") > 1, 5.0).alias("some"),
    )
    both = standardise(
        fit_features(rows, columns).transform(rows), scaler_values(rows, (*columns, "some"))
    )
    return both.select(
        *ROW_KEY,
        F.round(vector_to_array("scaled_features")[1], 4).alias("by_model"),
        F.round("constant_scaled", 4).alias("by_column"),
        F.round("some_scaled", 4).alias("with_missing"),
    )


def assign_missing(spark, sf_dir):
    """Rows with missing values have no label, by few terms and by many. The
    centres added for the many are nearest to no row."""
    far = [(-1e6 * (i + 1), -1e6, 0.0, 0.0) for i in range(13)]
    rows = _gaps(_lineitem(spark, sf_dir).select(*KEYS, *FEATURES))
    few = clustering.assign_nearest(rows, FEATURES, RAW_CENTERS, "few_terms")
    return clustering.assign_nearest(few, FEATURES, (*RAW_CENTERS, *far), "many_terms").select(
        *ROW_KEY, "few_terms", "many_terms"
    )


def silhouette_wide(spark, sf_dir):
    """Twenty groups by the supplier's number, so more terms than are written out."""
    scaled = standardised(spark, sf_dir)
    rows = scaled.withColumn("prediction", (F.col("l_suppkey") % 20).cast("int"))
    return silhouette(rows, SCALED).select(*_rounded(["silhouette"]))


def standardised(spark, sf_dir) -> DataFrame:
    rows = _lineitem(spark, sf_dir)
    return standardise(rows, scaler_values(rows, FEATURES))


def _labelled(spark, sf_dir) -> DataFrame:
    rows = _lineitem(spark, sf_dir).select(*KEYS, *FEATURES)
    return clustering.assign_nearest(rows, FEATURES, RAW_CENTERS)


def _scaled_labelled(spark, sf_dir) -> DataFrame:
    return clustering.assign_nearest(_scaled(spark, sf_dir), SCALED, SCALED_CENTERS)


def assign_fixed_centers(spark, sf_dir):
    return _labelled(spark, sf_dir).select(*ROW_KEY, "prediction")


def assign_scaled_centers(spark, sf_dir):
    return _scaled_labelled(spark, sf_dir).select(*ROW_KEY, "prediction")


def result_projection(spark, sf_dir):
    return clustering.result_columns(_labelled(spark, sf_dir), FEATURES, passthrough=KEYS)


def cluster_sizes(spark, sf_dir):
    return clustering.cluster_sizes(_labelled(spark, sf_dir))


def centers_of(spark, sf_dir):
    centers = clustering.centers_of(_labelled(spark, sf_dir), FEATURES)
    return centers.select("prediction", *_rounded(FEATURES))


def lloyd_step(spark, sf_dir):
    step = clustering.lloyd_step(_scaled(spark, sf_dir), SCALED, SCALED_CENTERS)
    return step.select("cluster", "cluster_size", *_rounded(SCALED))


KEYED_ROUNDS = 4


def kmeans_keyed(spark, sf_dir):
    fit = clustering.fit_keyed(_lineitem(spark, sf_dir), FEATURES, 5, KEYS, KEYED_ROUNDS)
    fields = {"cluster": "int", "cluster_size": "long"} | dict.fromkeys(FEATURES, "double")
    rows = [(i, n, *c) for i, (n, c) in enumerate(zip(fit.sizes, fit.centers))]
    return small_table(spark, fields, rows).select("cluster", "cluster_size", *_rounded(FEATURES))


def within_cluster_cost(spark, sf_dir):
    cost = clustering.within_cluster_cost(_scaled(spark, sf_dir), SCALED, SCALED_CENTERS)
    return cost.select(*_rounded(["cost"], 3))


def silhouette_fixed(spark, sf_dir):
    score = silhouette(_scaled_labelled(spark, sf_dir), SCALED)
    return score.select(*_rounded(["silhouette"]))


def silhouette_by_metric(spark, sf_dir):
    """The ML evaluator, chosen by metric name, on the same labels."""
    rows = assemble(_scaled_labelled(spark, sf_dir), SCALED, "scaled_features")
    score = clustering.evaluate(rows, metric="silhouette")
    return small_table(spark, {"silhouette": "double"}, [(round(score, 4),)])


def _fitted(spark, sf_dir):
    rows = _lineitem(spark, sf_dir).select(*KEYS, *FEATURES)
    return rows, clustering.fit_model(rows, FEATURES, ClusterSpec())


def kmeans_fit(spark, sf_dir):
    rows, model = _fitted(spark, sf_dir)
    return _fit_counts(
        clustering.model_centers(spark, model),
        clustering.cluster_sizes(clustering.predict(rows, model)),
    )


def _fit_counts(centers: DataFrame, sizes: DataFrame) -> DataFrame:
    """What does not depend on the fit: how many centres, and rows by labels of them."""
    counted = centers.join(sizes, centers.cluster == sizes.prediction, "full")
    return counted.agg(
        F.count("cluster").alias("n_centers"),
        F.sum("cluster_size").alias("n_rows"),
        F.sum(F.when(F.col("cluster").isNotNull(), F.col("cluster_size"))).alias("rows_within"),
    )


def _fit_checks(
    labelled: DataFrame, nearest: Column, own: Column, origin: Column, score: float, k: int
):
    """What has to hold of any fit, as one row over all rows.

    A distance by norms and dot product, as the model computes it, may differ
    in the last digits, hence the tolerance for the nearest centre.
    """
    checked = labelled.select("prediction", nearest.alias("d"), own.alias("own"), origin.alias("o"))
    return checked.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("own") > F.col("d") + 1e-6).alias("off_nearest"),
        F.count_if(~F.col("prediction").between(0, k - 1)).alias("off_range"),
        (F.count_distinct("prediction") > 1).alias("labels_used"),
        (F.sum("d") < F.sum("o")).alias("better_than_one_cluster"),
        F.lit(-1.0 <= score <= 1.0).alias("score_in_range"),
    )


def kmeans_invariants(spark, sf_dir):
    rows, model = _fitted(spark, sf_dir)
    predictions = clustering.predict(rows, model)
    score = clustering.evaluate(predictions)
    scaled = predictions.withColumn("_v", vector_to_array("scaled_features"))
    columns = [F.col("_v")[i].alias(c) for i, c in enumerate(SCALED)]
    centers = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    labelled = scaled.select("prediction", *columns).withColumn(
        "_distances", squared_distances(SCALED, centers)
    )
    return _fit_checks(
        labelled,
        F.array_min("_distances"),
        F.col("_distances")[F.col("prediction")],
        squared_distance(SCALED, [0.0] * len(SCALED)),
        score,
        len(centers),
    )


def _embeddings(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")
    )


def _fitted_embeddings(spark, sf_dir):
    vectors = _embeddings(spark, sf_dir).withColumn("scaled_features", array_to_vector("embedding"))
    return vectors, clustering.fit_kmeans(vectors, ClusterSpec(k=10))


def kmeans_embeddings(spark, sf_dir):
    vectors, model = _fitted_embeddings(spark, sf_dir)
    return _fit_counts(
        clustering.model_centers(spark, model),
        clustering.cluster_sizes(clustering.predict(vectors, model)),
    )


def kmeans_embeddings_invariants(spark, sf_dir):
    vectors, model = _fitted_embeddings(spark, sf_dir)
    predictions = clustering.predict(vectors, model)
    score = clustering.evaluate(predictions)
    centers = [[float(x) for x in c] for c in model.clusterCenters()]
    vector = F.col("embedding")
    by_label = F.create_map(
        *[x for i, c in enumerate(centers) for x in (F.lit(i), F.array(*map(F.lit, c)))]
    )
    own = F.zip_with(vector, by_label[F.col("prediction")], lambda x, c: (x - c) * (x - c))
    return _fit_checks(
        predictions,
        nearest_in_batches(vector, centers)["distance"],
        F.aggregate(own, F.lit(0.0), lambda total, d: total + d),
        nearest_in_batches(vector, [[0.0] * len(centers[0])])["distance"],
        score,
        len(centers),
    )


def assign_embeddings(spark, sf_dir):
    """Wide vectors labelled with the nearest of three axis points."""
    centers = [[1.0 if i == axis else 0.0 for i in range(64)] for axis in range(3)]
    rows = clustering.assign_nearest_array(_embeddings(spark, sf_dir), "embedding", centers)
    return rows.select("vec_id", "prediction")


def model_round_trip(spark, sf_dir):
    """A saved and reloaded model labels every row as before."""
    rows, model = _fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    clustering.save_model(model, path)
    before = clustering.predict(rows, model).drop("features", "scaled_features")
    both = clustering.predict(
        before.withColumnRenamed("prediction", "before"), clustering.load_model(path)
    )
    return both.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("prediction") != F.col("before")).alias("changed"),
    )


# --- points and collections -----------------------------------------------


def point_ids(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return dense_ids(parts, scratch_path(spark, "part-ids"), ["p_name", "p_partkey"])


def _numbered(spark, sf_dir) -> DataFrame:
    rows = cleaning.add_tier(_lineitem(spark, sf_dir).select(*KEYS, *FEATURES), PRICE_TIER)
    return dense_ids(rows, scratch_path(spark, "lineitem-ids"), ROW_KEY)


def point_ids_lineitem(spark, sf_dir):
    return _numbered(spark, sf_dir).select("id", *ROW_KEY)


def _point_columns(points: DataFrame, *extra: str) -> DataFrame:
    vector = [F.col("vector")[i].alias(n) for i, n in enumerate(VECTOR_NAMES)]
    return points.select("id", *vector, *[f"payload.{c}" for c in (*FEATURES, *extra)])


def points(spark, sf_dir):
    built = build_points(_numbered(spark, sf_dir), FEATURES, "price_tier")
    return _point_columns(built, "price_tier")


def clustered_points(spark, sf_dir):
    labelled = clustering.assign_nearest(_numbered(spark, sf_dir), FEATURES, RAW_CENTERS)
    built = build_points(labelled, FEATURES, "price_tier", "prediction")
    return _point_columns(built, "price_tier", "cluster")


def _part_points(spark, sf_dir) -> DataFrame:
    parts = _table(spark, sf_dir, "part").withColumnsRenamed({"p_partkey": "id"})
    doubles = parts.select("id", *[to_double(c).alias(c) for c in PART_COLUMNS], "p_name")
    return build_points(doubles, PART_COLUMNS, passthrough=["p_name"])


def _store(spark) -> CollectionStore:
    return CollectionStore(spark, scratch_path(spark, "collections"))


def _part_collection(spark, sf_dir):
    """The part table as a collection, ids by name, so they are dense."""
    store = _store(spark)
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name", *PART_COLUMNS)
    with store.staging("parts") as path:
        numbered = dense_ids(parts, path, ["p_name", "p_partkey"], together=True)
        points = build_points(numbered, PART_COLUMNS, passthrough=["p_name", "p_partkey"])
        store.recreate("parts", len(PART_COLUMNS), points=points, together=True)
    return store.open("parts")


def _page_columns(page: DataFrame) -> DataFrame:
    return page.select("id", "payload.p_partkey", "payload.p_name", "payload.p_retailprice")


def scroll_page(spark, sf_dir):
    return _page_columns(_part_collection(spark, sf_dir).scroll(50, 75))


def _spaced_collection(spark, sf_dir):
    """All parts under every third id, so that the ids have gaps."""
    store = _store(spark)
    spaced = _part_points(spark, sf_dir).withColumn("id", F.col("id") * 3)
    store.recreate("parts", len(PART_COLUMNS), points=spaced)
    return store.open("parts")


def scroll_page_gaps(spark, sf_dir):
    page = _spaced_collection(spark, sf_dir).scroll(40, 50)
    return page.select("id", "payload.p_name", "payload.p_retailprice")


def next_offset(spark, sf_dir):
    """Next offsets from several places, in collections without and with gaps;
    -1 stands for none."""
    collections = {
        "dense": _part_collection(spark, sf_dir),
        "spaced": _spaced_collection(spark, sf_dir),
    }
    rows = [
        (name, offset, collection.next_offset(40, None if offset < 0 else offset))
        for name, collection in collections.items()
        for offset in (-1, 50, 180)
    ]
    fields = {"ids": "string", "start": "long", "following": "long"}
    return small_table(spark, fields, rows).na.fill(-1, ["following"])


def full_scan(spark, sf_dir):
    return _part_collection(spark, sf_dir).scan(PART_COLUMNS)


def _upserted(spark, sf_dir) -> CollectionStore:
    """Parts of small size stored, then those of large size put over them at
    twice the price; sizes 20 to 25 are in both."""
    store = _store(spark)
    all_points = _part_points(spark, sf_dir)
    store.recreate("parts", len(PART_COLUMNS))
    store.upsert("parts", all_points.where("payload.p_size <= 25"))
    price = F.col("payload.p_retailprice") * 2
    dearer = all_points.where("payload.p_size >= 20").withColumn(
        "payload", F.col("payload").withField("p_retailprice", price)
    )
    store.upsert("parts", dearer)
    return store


def upsert(spark, sf_dir):
    stored = _upserted(spark, sf_dir).open("parts").points
    return stored.select("id", "payload.p_name", "payload.p_size", "payload.p_retailprice")


def upsert_twice(spark, sf_dir):
    """Putting the same points again changes nothing."""
    store = _upserted(spark, sf_dir)
    store.upsert("parts", store.open("parts").points)
    stored = store.open("parts").points
    return stored.select("id", "payload.p_name", "payload.p_size", "payload.p_retailprice")


def upsert_many(spark, sf_dir):
    """The way for more new points than can be broadcast, on the same points."""
    old = _part_points(spark, sf_dir).where("payload.p_size <= 25")
    price = F.col("payload.p_retailprice") * 2
    new = _part_points(spark, sf_dir).where("payload.p_size >= 20").withColumn(
        "payload", F.col("payload").withField("p_retailprice", price)
    )
    merged = CollectionStore.merge_many(old, new)
    return merged.select("id", "payload.p_name", "payload.p_size", "payload.p_retailprice")


def batches(spark, sf_dir):
    return batch_counts(_numbered(spark, sf_dir), CollectionSpec(root="").batch_size)


def collection_info(spark, sf_dir):
    store = _upserted(spark, sf_dir)
    return store.registry().select(
        "name", "vector_size", "distance", "points_count", "min_id", "max_id"
    )


def _several_collections(spark, sf_dir) -> CollectionStore:
    store = _store(spark)
    everything = _part_points(spark, sf_dir)
    store.recreate("parts", len(PART_COLUMNS), points=everything)
    store.recreate("small_parts", len(PART_COLUMNS), points=everything.where("payload.p_size < 5"))
    store.recreate("emptied_parts", len(PART_COLUMNS), points=everything)
    store.recreate("emptied_parts", len(PART_COLUMNS))
    return store


def list_collections(spark, sf_dir):
    store = _several_collections(spark, sf_dir)
    return store.list_collections().join(store.registry().select("name", "points_count"), "name")


def has_data(spark, sf_dir):
    store = _several_collections(spark, sf_dir)
    names = ("parts", "small_parts", "emptied_parts", "other_parts")
    rows = [(n, store.exists(n), store.has_data(n)) for n in names]
    fields = {"name": "string", "found": "boolean", "filled": "boolean"}
    return small_table(spark, fields, rows)


def pages_concatenated(spark, sf_dir):
    """All pages of a collection with gaps in its ids, put together."""
    store = _store(spark)
    points = _part_points(spark, sf_dir).withColumn("id", F.col("id") * 3)
    info = store.recreate("parts", len(PART_COLUMNS), points=points, block_size=500)
    pages = store.open("parts").pages(info.points_count // 7 + 1)
    return reduce(DataFrame.unionByName, pages).select("id", "payload.p_name", "payload.p_retailprice")


def delete_collection(spark, sf_dir):
    store = _several_collections(spark, sf_dir)
    names = ("parts", "small_parts", "emptied_parts")
    before = [store.exists(n) for n in names]
    store.delete("parts")
    rows = [(n, b, store.exists(n), store.has_data(n)) for n, b in zip(names, before)]
    fields = {"name": "string", "before": "boolean", "after": "boolean", "filled": "boolean"}
    return small_table(spark, fields, rows)


def empty_read_guard(spark, sf_dir):
    """Whether opening a collection for reading raises."""
    store = _several_collections(spark, sf_dir)

    def raises(name: str) -> bool:
        try:
            store.open(name)
        except (LookupError, ValueError):
            return True
        return False

    rows = [(n, raises(n)) for n in ("parts", "small_parts", "emptied_parts", "other_parts")]
    return small_table(spark, {"name": "string", "raised": "boolean"}, rows)


# --- whole jobs -----------------------------------------------------------


def run_modes(spark, sf_dir):
    """Rows that each mode puts out; without a mode, or with an unknown one, preprocess."""
    base = scratch_path(spark, "modes")
    _gaps(_lineitem(spark, sf_dir)).write.options(header=True, sep="\t").csv(f"{base}/raw")
    spec = PipelineSpec(
        source_path=f"{base}/raw",
        preprocessed_path=f"{base}/preprocessed",
        predictions_path=f"{base}/predictions",
        model_path=f"{base}/model",
        clean=CleanSpec(FEATURES, UPPER, None, None),
        collections=CollectionSpec(root=f"{base}/collections"),
    )

    def rows(mode: str | None) -> int:
        result = run_mode(spark, mode, spec)
        if isinstance(result, DataFrame):
            return result.count()
        if hasattr(result, "points_count"):
            return result.points_count
        return result.predictions.count()

    modes = ("upload", "preprocess", "cluster", "write-results", None, "anything")
    return small_table(spark, {"mode": "string", "n_rows": "long"}, [(m or "none", rows(m)) for m in modes])


def end_to_end(spark, sf_dir):
    """Text to clustered collection over the whole table: rows at every stage."""
    base = scratch_path(spark, "run")
    _gaps(_lineitem(spark, sf_dir)).write.options(header=True, sep="\t").csv(f"{base}/raw")
    spec = PipelineSpec(
        source_path=f"{base}/raw",
        preprocessed_path=f"{base}/preprocessed",
        predictions_path=f"{base}/predictions",
        model_path=f"{base}/model",
        clean=CleanSpec(FEATURES, UPPER, EXACT_BAND, PRICE_TIER),
        cluster=ClusterSpec(passthrough=("price_tier",)),
        collections=CollectionSpec(root=f"{base}/collections"),
    )
    result = run_all(spark, spec)
    published = CollectionStore(spark, spec.collections.root).open("products_clustered")
    stored = published.points.agg(
        F.count("*"),
        F.count_distinct("payload.cluster"),
        F.count_if(F.col("payload.price_tier") == "high"),
    ).first()
    sizes = result.clusters.sizes.agg(F.sum("cluster_size")).first()[0]
    rows = [
        ("ingested", result.ingested.points_count),
        ("preprocessed", result.preprocessed.count()),
        ("clustered", sizes),
        ("published", result.published.points_count),
        ("stored", stored[0]),
        ("clusters", stored[1]),
        ("high_tier", stored[2]),
    ]
    return small_table(spark, {"stage": "string", "n_rows": "long"}, rows)


# --- contract -------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Clean, scale, label with the nearest centre, count by tier and cluster."""
    cleaned = cleaning.clean(_lineitem(spark, SMALL), CHAIN)
    scaled = standardise(cleaned, scaler_values(cleaned, FEATURES))
    labelled = clustering.assign_nearest(scaled, SCALED, SCALED_CENTERS)
    return (
        labelled.groupBy("price_tier", "prediction")
        .agg(F.count("*").alias("n_rows"), F.round(F.avg("l_quantity"), 4).alias("avg_quantity"))
        .orderBy("price_tier", "prediction")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "select_features": select_features,
        "drop_missing": drop_missing,
        "non_negative": non_negative,
        "upper_bounds": upper_bounds,
        "quantile_bounds_default": _quantile_bounds(BandSpec()),
        "quantile_bounds_exact": _quantile_bounds(EXACT_BAND),
        "quantile_rank_error": quantile_rank_error,
        "quantile_band_default": _quantile_band(BandSpec()),
        "quantile_band_exact": _quantile_band(EXACT_BAND),
        "limit_keyed": limit_keyed,
        "tier_bucket": tier_bucket,
        "tier_counts": tier_counts,
        "preprocess_chain": preprocess_chain,
        "preprocess_chain_whole": preprocess_chain_whole,
        "preprocess_chain_default_band": preprocess_chain_default_band,
        "stage_funnel": stage_funnel,
        "csv_scan": csv_scan,
        "csv_feature_load": csv_feature_load,
        "safe_cast": safe_cast,
        "payload_schema": payload_schema,
        "parquet_round_trip": parquet_round_trip,
        "assemble": assemble_vector,
        "assemble_array": assemble_as_array,
        "scaler_stats": scaler_statistics,
        "standardise": standardise_columns,
        "feature_build": feature_build,
        "constant_column": constant_column,
        "assign_missing": assign_missing,
        "silhouette_wide": silhouette_wide,
        "assign_fixed_centers": assign_fixed_centers,
        "assign_scaled_centers": assign_scaled_centers,
        "assign_embeddings": assign_embeddings,
        "result_projection": result_projection,
        "cluster_sizes": cluster_sizes,
        "centers_of": centers_of,
        "lloyd_step": lloyd_step,
        "kmeans_keyed": kmeans_keyed,
        "within_cluster_cost": within_cluster_cost,
        "silhouette_fixed": silhouette_fixed,
        "silhouette_by_metric": silhouette_by_metric,
        "kmeans_fit": kmeans_fit,
        "kmeans_invariants": kmeans_invariants,
        "kmeans_embeddings": kmeans_embeddings,
        "kmeans_embeddings_invariants": kmeans_embeddings_invariants,
        "model_round_trip": model_round_trip,
        "point_ids": point_ids,
        "point_ids_lineitem": point_ids_lineitem,
        "points": points,
        "clustered_points": clustered_points,
        "scroll_page": scroll_page,
        "scroll_page_gaps": scroll_page_gaps,
        "next_offset": next_offset,
        "full_scan": full_scan,
        "upsert": upsert,
        "upsert_twice": upsert_twice,
        "upsert_many": upsert_many,
        "batch_counts": batches,
        "collection_info": collection_info,
        "list_collections": list_collections,
        "has_data": has_data,
        "pages_concatenated": pages_concatenated,
        "delete_collection": delete_collection,
        "empty_read_guard": empty_read_guard,
        "run_modes": run_modes,
        "end_to_end": end_to_end,
    } | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE) | (llm.oracle_sql() if llm else {})
