import math

import pytest
from pyspark.sql import functions as F

from featloom.functions.casts import to_double
from featloom.operators import clean as cleaning
from featloom.specs import BandSpec, CleanSpec, TierSpec

NAN = float("nan")


def values(df, column="x"):
    return [r[column] for r in df.collect()]


@pytest.fixture
def missing(spark):
    return spark.createDataFrame([(1.0,), (NAN,), (None,), (-1.0,)], "x double")


def test_null_and_nan_are_missing(missing):
    assert values(cleaning.drop_missing(missing, ["x"])) == [1.0, -1.0]


def test_nan_passes_the_sign_filter_alone(missing):
    kept = values(cleaning.keep_non_negative(missing, ["x"]))
    assert kept[0] == 1.0 and math.isnan(kept[1]) and len(kept) == 2


def test_missing_looks_at_the_named_columns_only(spark):
    df = spark.createDataFrame([(1.0, None), (None, "a")], "x double, other string")
    assert values(cleaning.drop_missing(df, ["x"])) == [1.0]


def test_bounds_are_strict_and_zero_is_kept(spark):
    df = spark.createDataFrame([(0.0,), (99.9,), (100.0,)], "x double")
    kept = cleaning.keep_below(cleaning.keep_non_negative(df, ["x"]), {"x": 100.0})
    assert values(kept) == [0.0, 99.9]


def test_band_includes_both_ends(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert values(cleaning.keep_within(df, {"x": (2.0, 3.0)})) == [2.0, 3.0]


def test_tiers_on_their_cut_points(spark):
    rows = [(0.0,), (149.9,), (150.0,), (350.0,), (350.1,), (None,), (NAN,)]
    df = spark.createDataFrame(rows, "energy_100g double")
    tiers = values(cleaning.add_tier(df, TierSpec()), "energy_tier")
    assert tiers == ["low", "low", "medium", "medium", "high", "high", "high"]


def test_limit_by_key_and_without(spark):
    df = spark.range(100).withColumn("x", F.lit(1.0)).repartition(8)
    assert values(cleaning.limit_rows(df, 3, ["id"]), "id") == [0, 1, 2]
    with pytest.raises(ValueError, match="order_by"):
        cleaning.limit_rows(df, 3)


def test_default_settings_keep_every_row(spark):
    df = spark.range(3000).select(*[F.lit(1.0).alias(c) for c in CleanSpec().columns])
    assert cleaning.clean(df, CleanSpec()).count() == 3000


def test_text_to_double(spark):
    texts = ["12.5", "abc", "", " 7 ", "1e3", "NaN"]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select(to_double("x").alias("x"))
    found = values(df)
    assert found[:5] == [12.5, None, None, 7.0, 1000.0] and math.isnan(found[5])


def test_strict_cast_fails_on_text(spark):
    df = spark.createDataFrame([("abc",)], "x string").select(to_double("x", strict=True))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.collect()


def products(spark, n=2000):
    """Rows of the default columns; every tenth is broken in one of five ways."""
    i = F.col("id")
    kind = F.when(i % 10 == 0, (i / 10).cast("int") % 5)
    return spark.range(n).select(
        F.when(kind == 0, None).when(kind == 1, 5000.0).otherwise(i % 500 + 0.5).alias("energy_100g"),
        F.when(kind == 2, -1.0).otherwise(i % 90).cast("double").alias("fat_100g"),
        F.when(kind == 3, 100.0).otherwise(i % 80).cast("double").alias("carbohydrates_100g"),
        F.when(kind == 4, NAN).otherwise(i % 70).cast("double").alias("sugars_100g"),
        (i % 60).cast("double").alias("proteins_100g"),
    )


def test_default_chain(spark):
    cleaned = cleaning.clean(products(spark), CleanSpec(row_limit=None))
    assert cleaned.columns == [*CleanSpec().columns, "energy_tier"]
    assert cleaned.count() == 1800
    assert cleaning.clean(products(spark), CleanSpec()).count() == 1800


def test_default_band_removes_nothing_and_an_exact_one_does(spark):
    fixed = cleaning.clean_fixed(products(spark), CleanSpec())
    default = cleaning.clean(products(spark), CleanSpec(row_limit=None))
    exact = cleaning.clean(
        products(spark), CleanSpec(row_limit=None, band=BandSpec(relative_error=0.0))
    )
    assert default.count() == fixed.count() > exact.count()


def test_chain_limits_before_the_tier_and_drops_a_key_not_asked_for(spark):
    df = products(spark).withColumn("row", F.monotonically_increasing_id())
    spec = CleanSpec(order_by=("row",), row_limit=10)
    cleaned = cleaning.clean(df, spec)
    assert cleaned.count() == 10 and "row" not in cleaned.columns


def test_stage_counts(spark):
    counts = cleaning.stage_counts(products(spark), CleanSpec(), {"energy_100g": (0.0, 400.0)})
    row = counts.first().asDict()
    assert row["input_rows"] == 2000
    assert row["after_missing"] == 1920
    assert row["after_non_negative"] == 1880
    assert row["after_upper_bounds"] == 1800
    assert 0 < row["after_band"] < 1800
