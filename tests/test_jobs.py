from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from featloom.__main__ import _parser, _spec, main
from featloom.plans import jobs
from featloom.operators.cluster import evaluate, load_model, predict
from featloom.sources.collection import CollectionStore
from featloom.sources.parquet import write_counted
from featloom.sources.delimited import load_features, read_delimited
from featloom.specs import BandSpec, CleanSpec, CollectionSpec, PipelineSpec, TierSpec

from test_clean import products


@pytest.fixture(scope="module")
def spec(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    raw = products(spark).select(
        F.lit("name").alias("product"),
        *products(spark).columns,
    )
    text = raw.select([F.col(c).cast("string").alias(c) for c in raw.columns])
    # Besides the broken rows of the table, some text where numbers belong.
    text = text.withColumn(
        "fat_100g", F.when(F.col("fat_100g") == "33.0", "unknown").otherwise(F.col("fat_100g"))
    )
    text.write.options(header=True, sep="\t").csv(str(base / "raw"))
    return PipelineSpec(
        source_path=str(base / "raw"),
        preprocessed_path=str(base / "preprocessed"),
        predictions_path=str(base / "predictions"),
        model_path=str(base / "model"),
        collections=CollectionSpec(root=str(base / "collections")),
    )


def test_text_is_read_as_strings_or_typed(spark, spec):
    texts = read_delimited(spark, spec.source_path)
    assert {t for _, t in texts.dtypes} == {"string"}
    typed = dict(read_delimited(spark, spec.source_path, infer_types=True).dtypes)
    assert typed["energy_100g"] == "double" and typed["fat_100g"] == "string"
    given = read_delimited(spark, spec.source_path, schema="product string, energy_100g double")
    assert given.columns == ["product", "energy_100g"]


def test_load_drops_what_is_no_number(spark, spec):
    columns = spec.clean.columns
    loaded = load_features(spark, spec.source_path, columns, passthrough=["product"])
    assert loaded.columns == [*columns, "product"]
    expected = products(spark).na.drop().where("fat_100g <> 33.0")
    assert sorted(loaded.select(*columns).collect()) == sorted(expected.collect())


def test_all_jobs(spark, spec):
    result = jobs.run_all(spark, spec)
    loaded = products(spark).na.drop().where("fat_100g <> 33.0").count()
    assert result.ingested.points_count == loaded
    assert result.preprocessed.count() == 1778
    assert result.preprocessed.columns == [*spec.clean.columns, "energy_tier"]
    clusters = result.clusters
    assert clusters.predictions.dtypes == [*[(c, "double") for c in spec.clean.columns], ("prediction", "int")]
    assert clusters.sizes.agg(F.sum("cluster_size")).first()[0] == 1778
    assert clusters.centers.count() == 5 and -1 <= clusters.silhouette <= 1
    assert result.published.points_count == 1778

    store = CollectionStore(spark, spec.collections.root)
    names = [r["name"] for r in store.list_collections().collect()]
    assert names == ["products_clustered", "products_raw"]
    stored = store.open("products_clustered").points
    assert set(stored.schema["payload"].dataType.fieldNames()) == {*spec.clean.columns, "cluster"}
    # The vectors are the plain columns, in order.
    unlike = F.col("vector") != F.array(*[f"payload.{c}" for c in spec.clean.columns])
    assert stored.where(unlike).count() == 0
    counts = dict(stored.groupBy("payload.cluster").count().collect())
    assert counts == {r["prediction"]: r["cluster_size"] for r in clusters.sizes.collect()}

    # The score is the one of the evaluator over the scaled vectors.
    scored = predict(result.preprocessed, clusters.model)
    assert clusters.silhouette == pytest.approx(evaluate(scored), abs=1e-9)

    # The saved model brings its scaler and labels the plain columns again.
    again = predict(result.preprocessed, load_model(spec.model_path))
    assert dict(again.groupBy("prediction").count().collect()) == counts


def test_a_rerun_replaces_and_does_not_ingest_again(spark, spec):
    store = CollectionStore(spark, spec.collections.root)
    jobs.run_all(spark, spec)
    version = store.info("products_raw").version
    jobs.run_all(spark, replace(spec, source_path="/nowhere"))
    assert store.info("products_raw").version == version
    assert store.info("products_clustered").points_count == 1778


def test_the_tier_can_be_carried_to_the_end(spark, spec):
    jobs.run_all(spark, spec)
    carried = replace(spec, cluster=replace(spec.cluster, passthrough=("energy_tier",)))
    jobs.run_mode(spark, "cluster", carried)
    jobs.run_mode(spark, "write-results", carried)
    stored = CollectionStore(spark, spec.collections.root).open("products_clustered").points
    tiers = {r[0] for r in stored.select("payload.energy_tier").distinct().collect()}
    assert tiers <= {"low", "medium", "high"} and tiers


def test_modes(spark, spec):
    assert jobs.run_mode(spark, "upload", spec).name == "products_raw"
    for mode in ("preprocess", None, "anything"):
        assert "energy_tier" in jobs.run_mode(spark, mode, spec).columns


def test_preprocess_without_data(spark, spec, tmp_path):
    empty = replace(spec, collections=CollectionSpec(root=str(tmp_path)))
    with pytest.raises(LookupError):
        jobs.preprocess(spark, empty)


PATHS = ["--root", "/r", "--source-path", "/s", "--preprocessed-path", "/p", "--predictions-path", "/q", "--model-path", "/m"]


def test_command_line():
    assert _parser().parse_args(PATHS).mode == "preprocess"
    paths = PATHS
    spec = _spec(_parser().parse_args(["all", "--k", "3", *paths]))
    assert spec == PipelineSpec("/s", "/p", "/q", "/m", CollectionSpec("/r"), cluster=replace(spec.cluster, k=3))
    assert spec.clean.row_limit is None
    more = ["--columns", "a,b", "--upper-bound", "a=5", "--tier", "b:1:2:grade", "--band", "0.1:0.9:0",
            "--order-by", "key", "--passthrough", "key,name", "--row-limit", "7"]
    clean = _spec(_parser().parse_args(["preprocess", *paths, *more])).clean
    assert clean == CleanSpec(
        ("a", "b"), {"a": 5.0}, BandSpec(0.1, 0.9, 0.0), TierSpec("b", 1.0, 2.0, "grade"), 7, ("key",), ("key", "name")
    )
    none = _spec(_parser().parse_args(["preprocess", *paths, "--columns", "a", "--tier", "none", "--band", "none"])).clean
    assert none == CleanSpec(("a",), {}, None, None)


def test_any_table_by_arguments_alone(spark, sf_dir, tmp_path, monkeypatch):
    columns = ("l_quantity", "l_tax")
    base = str(tmp_path)
    table = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    table.write.options(header=True, sep="\t").csv(f"{base}/raw")
    arguments = ["--root", f"{base}/c", "--source-path", f"{base}/raw", "--preprocessed-path", f"{base}/p",
                 "--predictions-path", f"{base}/q", "--model-path", f"{base}/m", "--columns", ",".join(columns),
                 "--upper-bound", "l_quantity=40", "--tier", "l_quantity:10:20:size", "--band", "none",
                 "--passthrough", "l_orderkey"]
    monkeypatch.setattr(spark, "stop", lambda: None)
    main(["upload", *arguments])
    main(["preprocess", *arguments])
    found = spark.read.parquet(f"{base}/p")
    assert found.columns == ["l_orderkey", *columns, "size"]
    assert found.count() == table.where("l_quantity < 40").count()


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    """By the writing job itself: no other job starts."""
    df = spark.range(1000).where("id % 3 = 0")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        assert write_counted(df, str(tmp_path / "out")) == 334
        assert len(tracker.getJobIdsForGroup("counted")) == 1
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert write_counted(df.where("id < 0"), str(tmp_path / "out")) == 0
    assert write_counted(spark.createDataFrame([], "x int"), str(tmp_path / "out")) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 0
