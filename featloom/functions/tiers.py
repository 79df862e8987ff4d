from __future__ import annotations

from pyspark.sql import Column, functions as F

from featloom.specs import TierSpec


def tier(spec: TierSpec) -> Column:
    """Three-way bucket of one column. Null and NaN fall into the last tier."""
    low, medium, high = spec.labels
    value = F.col(spec.column)
    return (
        F.when(value < spec.low_below, low)
        .when(value <= spec.medium_upto, medium)
        .otherwise(high)
        .alias(spec.output)
    )
