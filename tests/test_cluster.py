import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featloom.functions import vectors
from featloom.operators import cluster as clustering
from featloom.operators.features import (
    assemble,
    assemble_array,
    fit_features,
    scaler_values,
    standardise,
)
from featloom.operators import silhouette as scoring
from featloom.operators.silhouette import silhouette
from featloom.specs import ClusterSpec


def blobs(spark, k=4, each=50, columns=2):
    draw = np.random.default_rng(3)
    rows = [
        (g, *(float(v) for v in 100 * (g + 1) * (np.arange(columns) % (g + 2) + 1) + draw.normal(size=columns)))
        for g in range(k)
        for _ in range(each)
    ]
    names = [f"x{i}" for i in range(columns)]
    return spark.createDataFrame(rows, ["g", *names]).repartition(4), names


def test_standardise_matches_the_fitted_scaler(spark):
    df, names = blobs(spark)
    built = fit_features(df, names).transform(df)
    both = standardise(built, scaler_values(df, names)).select(
        vector_to_array("scaled_features").alias("v"), *[f"{c}_scaled" for c in names]
    )
    for row in both.collect():
        assert row["v"] == pytest.approx(list(row)[1:], abs=1e-12)


def test_a_column_without_spread_is_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 3.0)], "x double, y double")
    rows = standardise(df, scaler_values(df, ["x", "y"])).collect()
    assert [r["x_scaled"] for r in rows] == [0.0] * 3
    assert [r["y_scaled"] for r in rows] == [-1.0, 0.0, 1.0]


def test_a_single_row_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,)], "x double")
    assert standardise(df, scaler_values(df, ["x"])).first()["x_scaled"] == 0.0


def test_assembling_a_missing_value_fails(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with pytest.raises(Exception, match="null"):
        assemble(df, ["x"]).collect()


def test_a_tie_goes_to_the_lower_label(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double")
    by_columns = clustering.assign_nearest(df, ["x"], [[0.0], [2.0]])
    assert [r["prediction"] for r in by_columns.orderBy("x").collect()] == [0, 0, 1]
    by_array = clustering.assign_nearest_array(assemble_array(df, ["x"]), "features", [[0.0], [2.0]])
    assert [r["prediction"] for r in by_array.orderBy("x").collect()] == [0, 0, 1]


def test_one_centre_and_a_wrong_width(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "x double")
    assert {r["prediction"] for r in clustering.assign_nearest(df, ["x"], [[9.0]]).collect()} == {0}
    with pytest.raises(ValueError):
        clustering.assign_nearest(df, ["x"], [[1.0, 2.0]])


def test_wide_centres_give_the_same_labels_and_cost(spark):
    """20 columns by 8 centres is beyond what is written out as expressions."""
    df, names = blobs(spark, k=8, each=20, columns=20)
    x = np.array(df.select(*names).collect())
    centers = x[::17][:8] + 0.25
    distances = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
    labelled = clustering.assign_nearest(df, names, centers.tolist()).select(*names, "prediction")
    expected = {tuple(row): int(label) for row, label in zip(x, distances.argmin(axis=1))}
    assert {tuple(r)[:-1]: r["prediction"] for r in labelled.collect()} == expected
    cost = clustering.within_cluster_cost(df, names, centers.tolist()).first()["cost"]
    assert cost == pytest.approx(distances.min(axis=1).sum())


def test_a_null_vector_has_no_label(spark):
    df = spark.createDataFrame([([1.0, 1.0],), (None,)], "v array<double>")
    rows = clustering.assign_nearest_array(df, "v", [[0.0, 0.0], [1.0, 1.0]]).collect()
    assert [(r["v"] is None, r["prediction"]) for r in rows] == [(False, 1), (True, None)]


def test_fit_finds_separated_groups(spark):
    df, names = blobs(spark)
    model = clustering.fit_model(df, names, ClusterSpec(k=4))
    labels = clustering.predict(df, model).groupBy("g").agg(F.collect_set("prediction").alias("p"))
    found = [r["p"] for r in labels.collect()]
    assert all(len(p) == 1 for p in found) and len({p[0] for p in found}) == 4


def test_a_fit_over_the_same_stored_rows_is_the_same(spark, tmp_path):
    df, names = blobs(spark, k=6, each=40, columns=3)
    df.write.parquet(str(tmp_path / "rows"))
    fits = [
        clustering.fit_model(spark.read.parquet(str(tmp_path / "rows")), names, ClusterSpec(k=4))
        for _ in range(2)
    ]
    first, second = (clustering.model_centers(spark, m).collect() for m in fits)
    assert first == second


def test_what_holds_of_any_fit(spark):
    df, names = blobs(spark, k=3, each=40, columns=3)
    model = clustering.fit_model(df, names, ClusterSpec(k=5))
    predictions = clustering.predict(df, model)
    sizes = clustering.cluster_sizes(predictions).collect()
    assert sum(r["cluster_size"] for r in sizes) == 120
    assert [r["prediction"] for r in sizes] == sorted(r["prediction"] for r in sizes)
    assert {r["prediction"] for r in sizes} <= set(range(5))
    assert -1 <= clustering.evaluate(predictions) <= 1
    centers = clustering.model_centers(spark, model).collect()
    assert [r["cluster"] for r in centers] == list(range(5))
    arrays = predictions.withColumn("v", vector_to_array("scaled_features"))
    by_hand = clustering.assign_nearest_array(arrays, "v", [r["center"] for r in centers], "again")
    assert by_hand.where("again <> prediction").count() == 0


def test_silhouette_agrees_with_the_evaluator(spark):
    df, names = blobs(spark, k=3, each=30)
    near = [[100.0, 200.0], [200.0, 300.0], [310.0, 590.0]]
    labelled = clustering.assign_nearest(df, names, near)
    expected = clustering.evaluate(assemble(labelled, names, "scaled_features"))
    assert silhouette(labelled, names).first()["silhouette"] == pytest.approx(expected, abs=1e-9)


def test_silhouette_of_wide_rows_agrees_too(spark):
    df, names = blobs(spark, k=5, each=10, columns=20)
    expected = clustering.evaluate(
        assemble(df.withColumnRenamed("g", "prediction"), names, "scaled_features")
    )
    found = silhouette(df, names, "g").first()["silhouette"]
    assert found == pytest.approx(expected, abs=1e-9)


def test_silhouette_of_a_row_alone_is_zero(spark):
    df = spark.createDataFrame([(0.0, 0), (0.0, 0), (9.0, 1)], "x double, prediction int")
    assert silhouette(df, ["x"]).first()["silhouette"] == pytest.approx(2 / 3)
    with pytest.raises(ValueError):
        silhouette(df.where("prediction = 0"), ["x"])


def test_saved_model_predicts_the_same(spark, tmp_path):
    df, names = blobs(spark)
    model = clustering.fit_model(df, names, ClusterSpec(k=4))
    path = str(tmp_path / "model")
    clustering.save_model(model, path)
    clustering.save_model(model, path)
    again = clustering.load_model(path)
    expected = clustering.predict(df, model).select(*names, "prediction").collect()
    assert sorted(clustering.predict(df, again).select(*names, "prediction").collect()) == sorted(expected)


def test_lloyd_step_does_not_raise_the_cost(spark):
    df, names = blobs(spark, k=3)
    centers = [[0.0, 0.0], [150.0, 300.0], [400.0, 100.0]]
    cost = clustering.within_cluster_cost(df, names, centers).first()["cost"]
    step = clustering.lloyd_step(df, names, centers).collect()
    moved = [[r[c] for c in names] for r in step]
    assert clustering.within_cluster_cost(df, names, moved).first()["cost"] <= cost


def test_a_fit_does_not_depend_on_the_cluster(spark):
    df, names = blobs(spark, k=3, each=40, columns=3)
    spec = ClusterSpec(k=4, partitions=3)
    centers = [clustering.model_centers(spark, clustering.fit_model(df, names, spec)).collect() for _ in range(2)]
    assert centers[0] == centers[1]


def test_many_rows_are_fitted_in_partitions_of_bounded_size(spark, tmp_path, monkeypatch):
    df, names = blobs(spark, k=4, each=250, columns=3)
    df.coalesce(1).write.parquet(str(tmp_path / "rows"))
    stored, sizes = spark.read.parquet(str(tmp_path / "rows")), []
    fit = clustering.KMeans.fit

    def noted(self, rows):
        sizes.append(rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())
        return fit(self, rows)

    monkeypatch.setattr(clustering.KMeans, "fit", noted)
    few = clustering.fit_model(stored, names, ClusterSpec(k=4))
    monkeypatch.setattr(clustering, "_KEPT_BYTES", 100 * (clustering._ROW_BYTES + 8 * 3), raising=False)
    many = [clustering.fit_model(stored, names, ClusterSpec(k=4)) for _ in range(2)]
    vectors = few.stages[0].transform(stored)
    clustering.fit_kmeans(vectors, ClusterSpec(k=4, scaled_features_col="features"))
    assert sizes[0] == [1000]
    for found in sizes[1:]:
        assert len(found) == 10 and max(found) < 200 and sum(found) == 1000
    centers = [clustering.model_centers(spark, m).collect() for m in many]
    assert centers[0] == centers[1]
    assert clustering.predict(stored, many[0]).count() == 1000


@pytest.mark.parametrize("terms", [0, 1_000_000])
def test_missing_values_have_no_label_either_way(spark, monkeypatch, terms):
    monkeypatch.setattr(vectors, "WRITTEN_OUT_TERMS", terms)
    rows = [(None, 1.0), (float("nan"), 1.0), (5.0, 1.0), (0.0, 0.0), (0.1, 0.2)]
    df = spark.createDataFrame(rows, "a double, b double")
    centers = [[0.0, 0.0], [5.0, 1.0], [0.1, 0.3]]
    found = clustering.assign_nearest(df, ["a", "b"], centers).collect()
    assert [r["prediction"] for r in found] == [None, None, 1, 0, 2]
    array = df.withColumn("v", F.array("a", "b"))
    found = clustering.assign_nearest_array(array, "v", centers).collect()
    assert [r["prediction"] for r in found] == [None, None, 1, 0, 2]
    cost = clustering.within_cluster_cost(df, ["a", "b"], centers).first()["cost"]
    assert cost == pytest.approx(0.01)


def test_both_forms_give_the_same_bits(spark, monkeypatch):
    df, names = blobs(spark, k=5, each=40, columns=9)
    centers = [[100.0 * i + j for j in range(9)] for i in range(20)]
    found = []
    for terms in (0, 1_000_000):
        monkeypatch.setattr(vectors, "WRITTEN_OUT_TERMS", terms)
        labelled = clustering.assign_nearest(df, names, centers)
        score = silhouette(labelled, names).first()["silhouette"]
        cost = clustering.within_cluster_cost(df, names, centers).first()["cost"]
        found.append((sorted(map(tuple, labelled.collect())), pytest.approx(score, abs=1e-12), cost))
    assert found[0] == found[1]


@pytest.mark.parametrize("terms", [0, 1_000_000])
def test_silhouette_leaves_out_missing_values_and_takes_text_labels(spark, monkeypatch, terms):
    monkeypatch.setattr(vectors, "WRITTEN_OUT_TERMS", terms)
    rows = [(0.0, "x"), (0.0, "x"), (9.0, "y"), (None, "x"), (float("nan"), "y")]
    df = spark.createDataFrame(rows, "a double, prediction string")
    assert silhouette(df, ["a"]).first()["silhouette"] == pytest.approx(2 / 3)


@pytest.mark.parametrize("terms", [0, 1_000_000])
def test_silhouette_leaves_out_rows_without_label(spark, monkeypatch, terms):
    monkeypatch.setattr(vectors, "WRITTEN_OUT_TERMS", terms)
    rows = [(0.0, 0), (0.0, 0), (9.0, 1), (4.0, None), (None, None), (None, 2)]
    df = spark.createDataFrame(rows, "a double, prediction int")
    assert silhouette(df, ["a"]).first()["silhouette"] == pytest.approx(2 / 3)


def test_silhouette_has_a_bound_of_clusters(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MAX_CLUSTERS", 3)
    df = spark.range(5).select(F.col("id").cast("double").alias("a"), F.col("id").alias("prediction"))
    with pytest.raises(ValueError, match="more than 3"):
        silhouette(df, ["a"])


def test_vectors_of_a_sliced_batch(spark):
    lists = pa.array([[9.0, 9.0], [1.0, None], None, [2.0, 3.0]], pa.list_(pa.float32()))
    found = vectors.as_matrix(lists[1:], 2)
    assert np.array_equal(found, [[1.0, np.nan], [2.0, 3.0]], equal_nan=True)


def test_a_keyed_fit_does_not_depend_on_the_partitions(spark):
    df, names = blobs(spark, k=4, each=60, columns=3)
    keyed = df.withColumn("key", F.concat_ws("/", *names))
    gaps = keyed.unionByName(keyed.limit(3).withColumn(names[0], F.lit(None).cast("double")))
    fits = [
        clustering.fit_keyed(rows, names, 4, ["key"])
        for rows in (gaps.repartition(1), gaps.repartition(7), gaps.orderBy(F.desc(names[1])).repartition(3, "key"))
    ]
    assert fits[0] == fits[1] == fits[2]
    assert fits[0].settled and sum(fits[0].sizes) == 240
    cost = lambda centers: clustering.within_cluster_cost(gaps, names, centers).first()["cost"]
    assert cost(fits[0].centers) <= cost(clustering.keyed_seeds(gaps, names, 4, ["key"]))


def test_a_keyed_fit_of_equal_rows_and_of_too_few(spark):
    df = spark.createDataFrame([(i, 2.0, 3.0) for i in range(5)], "key int, a double, b double")
    fit = clustering.fit_keyed(df, ["a", "b"], 3, ["key"])
    assert fit.sizes == [5, 0, 0] and fit.centers == [[2.0, 3.0]] * 3 and fit.settled
    with pytest.raises(ValueError, match="5 rows"):
        clustering.fit_keyed(df, ["a", "b"], 6, ["key"])
