import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from featloom.operators import quantiles
from featloom.operators.quantiles import exact_quantiles, quantile_bounds
from featloom.specs import BandSpec

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def by_sorting(values, p):
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    return ordered[max(1, math.ceil(p * len(ordered))) - 1]


def frames(kind):
    draw = random.Random(7)
    n = 6000
    if kind == "spread":
        return [draw.gauss(0, 1) for _ in range(n)]
    if kind == "one value holds a third":
        return [5.0 if i % 3 == 0 else draw.uniform(0, 10) for i in range(n)]
    if kind == "two values":
        return [1.0 if i % 2 else 2.0 for i in range(n)]
    if kind == "one value":
        return [3.0] * n
    if kind == "gaps":
        return [draw.choice([None, float("nan"), draw.gauss(0, 100)]) for _ in range(n)]
    return [float(-(2**i % 1009)) for i in range(n)]


@pytest.mark.parametrize(
    "kind", ["spread", "one value holds a third", "two values", "one value", "gaps", "powers"]
)
@pytest.mark.parametrize("sortable", [0, 5, 10_000])
def test_exact_is_the_ranked_value(spark, monkeypatch, kind, sortable):
    """Also with so few sortable values that the narrowing has to go all the way."""
    monkeypatch.setattr(quantiles, "_SORTABLE_VALUES", sortable)
    monkeypatch.setattr(quantiles, "_NARROWING_ACCURACY", 50)
    x = frames(kind)
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(x)], "x double, y double")
    found = exact_quantiles(df.repartition(4), ["x", "y"], PROBABILITIES)
    assert found["x"] == [by_sorting(x, p) for p in PROBABILITIES]
    assert found["y"] == [by_sorting(range(len(x)), p) for p in PROBABILITIES]


def test_a_sketch_that_misses_is_corrected_by_the_counts(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_SORTABLE_VALUES", 10)
    monkeypatch.setattr(
        quantiles, "_around", lambda fractions: [0.6 for _ in fractions for _ in range(2)]
    )
    df = spark.range(1, 2001).select(F.col("id").cast("double").alias("x"))
    assert exact_quantiles(df, ["x"], [0.01, 0.99]) == {"x": [20.0, 1980.0]}


def test_a_large_error_gives_minimum_and_maximum(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert quantile_bounds(df, ["x"], BandSpec()) == {"x": (0.0, 999.0)}


@pytest.mark.parametrize("error", [0.0, 0.01])
def test_nothing_to_take_quantiles_of(spark, error):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    with pytest.raises(ValueError, match="y"):
        quantile_bounds(df, ["x", "y"], BandSpec(relative_error=error))
    with pytest.raises(ValueError, match="x, y"):
        quantile_bounds(df.limit(0), ["x", "y"], BandSpec(relative_error=error))


@pytest.mark.parametrize("rows, sortable, passes", [(200_000, 10_000, 2), (50_000, 100, 3)])
def test_a_pass_counts_and_gets_the_next_one_ready(spark, monkeypatch, rows, sortable, passes):
    """One sketch, then a pass for every hundredth; not a second sketch each time."""
    monkeypatch.setattr(quantiles, "_SORTABLE_VALUES", sortable)
    df = spark.range(rows).select(((F.col("id") * 7919) % rows).cast("double").alias("x"), F.rand(2).alias("y"))
    scans = []
    first = type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: scans.append(1) or first(self))
    found = exact_quantiles(df, ["x", "y"], [0.01, 0.99])
    assert found["x"] == [rows * 0.01 - 1, rows * 0.99 - 1] and len(scans) == passes


def test_windows_reach_the_scan(spark, sf_dir):
    searches = [
        quantiles._Search("l_extendedprice", 5, 100, low=950.0, high=960.0),
        quantiles._Search("l_quantity", 5, 100, low=2.0),
    ]
    plan = plan_of(spark.read.parquet(f"{sf_dir}/lineitem.parquet").where(quantiles._windows(searches)))
    assert "Or(And(GreaterThan(l_extendedprice,950.0),LessThan(l_extendedprice,960.0)),GreaterThan(l_quantity,2.0))" in plan
