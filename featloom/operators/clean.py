"""Cleaning steps for a numeric feature table, and their chain.

All steps but the quantile band are lazy. They stay plain filters, so that on a
Parquet source they end up in the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from featloom.functions.predicates import all_below, all_non_negative, all_present, all_within
from featloom.functions.tiers import tier
from featloom.operators.quantiles import quantile_bounds
from featloom.specs import CleanSpec, TierSpec


def select_features(
    df: DataFrame, columns: Sequence[str], passthrough: Sequence[str] = ()
) -> DataFrame:
    """The passthrough columns, then the configured ones, in order."""
    keep = [c for c in passthrough if c not in columns]
    return df.select(*keep, *columns)


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns."""
    return df.na.drop("any", subset=list(columns))


def keep_non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(all_non_negative(columns))


def keep_below(df: DataFrame, upper_bounds: Mapping[str, float]) -> DataFrame:
    return df.where(all_below(upper_bounds))


def keep_within(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.where(all_within(bounds))


def limit_rows(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first n rows by the key; without a key it would be any n, so it is asked for."""
    if not order_by:
        raise ValueError("a row limit needs order_by")
    return df.orderBy(*order_by).limit(n)


def add_tier(df: DataFrame, spec: TierSpec) -> DataFrame:
    return df.withColumn(spec.output, tier(spec))


def clean_fixed(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """The steps that need nothing from the data: one project and one filter."""
    keys = (*spec.passthrough, *spec.order_by)
    return (
        df.transform(select_features, spec.columns, tuple(dict.fromkeys(keys)))
        .transform(drop_missing, spec.columns)
        .transform(keep_non_negative, spec.columns)
        .transform(keep_below, spec.upper_bounds)
    )


def clean(
    df: DataFrame, spec: CleanSpec, bounds: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """The whole chain: project, missing, sign, upper bounds, band, limit, tier.

    Runs the quantile job over the rows left by the fixed steps unless the
    bounds are given. The bounds enter the plan as literals, so the final scan
    gets them as pushed filters.
    """
    rows = clean_fixed(df, spec)
    if spec.band is not None:
        if bounds is None:
            bounds = quantile_bounds(rows, spec.columns, spec.band)
        rows = keep_within(rows, bounds)
    if spec.row_limit is not None:
        rows = limit_rows(rows, spec.row_limit, spec.order_by)
    if spec.tier is not None:
        rows = add_tier(rows, spec.tier)
    extra = [c for c in spec.order_by if c not in spec.passthrough and c not in spec.columns]
    return rows.drop(*extra)


def stage_counts(
    df: DataFrame, spec: CleanSpec, bounds: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Rows left after each step, all from one pass, as one row of counts.

    The band is counted only with ``bounds`` given.
    """
    stages = {
        "after_missing": all_present(spec.columns),
        "after_non_negative": all_non_negative(spec.columns),
        "after_upper_bounds": all_below(spec.upper_bounds),
    }
    if bounds is not None:
        stages["after_band"] = all_within(bounds)
    conditions = list(stages.values())
    counts = [
        F.count_if(reduce(and_, conditions[: i + 1])).alias(name) for i, name in enumerate(stages)
    ]
    return df.agg(F.count("*").alias("input_rows"), *counts)
