"""Shapes of plans that have to hold at any size."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import plan_of
from featloom.functions import vectors
from featloom.operators import clean as cleaning
from featloom.operators import cluster as clustering
from featloom.operators import silhouette as scoring


@pytest.fixture(scope="module")
def lineitem(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def test_fixed_steps_are_one_filter_in_the_scan(lineitem):
    plan = plan_of(cleaning.clean_fixed(lineitem, registered.CHAIN))
    assert plan.count("Filter (") == 1 and "Exchange" not in plan and "*(1)" in plan
    for pushed in ("IsNotNull(l_tax)", "GreaterThanOrEqual(l_tax,0.0)", "LessThan(l_quantity,50.0)"):
        assert pushed in plan
    assert "l_shipdate" not in plan


def test_band_is_pushed_as_literals_and_nothing_shuffles(lineitem):
    plan = plan_of(cleaning.clean(lineitem, registered.CHAIN))
    assert "Exchange" not in plan and "Join" not in plan
    assert "LessThanOrEqual(l_extendedprice," in plan


def test_keyed_limit_does_not_sort_the_table(lineitem):
    plan = plan_of(cleaning.limit_rows(lineitem, 10, registered.ROW_KEY))
    assert "TakeOrderedAndProject" in plan


def test_labels_stay_in_generated_code(lineitem):
    labelled = clustering.assign_nearest(lineitem, registered.FEATURES, registered.RAW_CENTERS)
    plan = plan_of(labelled.select("prediction"))
    assert "Exchange" not in plan and "Python" not in plan and "*(1) Project" in plan


def test_sizes_combine_before_the_shuffle(lineitem):
    labelled = clustering.assign_nearest(lineitem, registered.FEATURES, registered.RAW_CENTERS)
    plan = plan_of(clustering.cluster_sizes(labelled))
    assert "partial_count(1)" in plan


def test_stage_counts_are_one_pass(lineitem):
    plan = plan_of(cleaning.stage_counts(lineitem, registered.CHAIN))
    assert plan.count("FileScan") == 1


def test_no_filter_computes_a_label_again(spark, sf_dir, monkeypatch):
    """Neither pass of a score over labels of the same plan."""
    labelled = registered._scaled_labelled(spark, sf_dir)
    moments = scoring.cluster_moments(labelled, registered.SCALED)
    found = scoring._moments(labelled, registered.SCALED, "prediction")
    monkeypatch.setattr(scoring, "_moments", lambda *_: found)
    for df in (moments, scoring.silhouette(labelled, registered.SCALED)):
        plan = plan_of(df)
        assert "array_position" in plan and "Filter (" not in plan


def test_wide_labels_and_scores_move_arrow_columns(spark, monkeypatch):
    monkeypatch.setattr(vectors, "WRITTEN_OUT_TERMS", 0)
    df = spark.createDataFrame([(0.0, 1.0), (0.5, 1.0), (9.0, 2.0)], "a double, b double")
    labelled = clustering.assign_nearest(df, ["a", "b"], [[0.0, 0.0], [9.0, 0.0]])
    for plan in (plan_of(labelled), plan_of(scoring.silhouette(labelled, ["a", "b"]))):
        assert "ArrowEvalPython" in plan and "pandas" not in plan.lower()
