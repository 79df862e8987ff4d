"""Points: id, vector and payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from featloom.functions.payload import batch_number, payload
from featloom.functions.vectors import feature_array


def build_points(
    numbered: DataFrame,
    columns: Sequence[str],
    tier_col: str = "energy_tier",
    prediction_col: str | None = None,
    id_col: str = "id",
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """Points of numbered rows. The vector holds the columns as they are, not
    scaled; the payload has them by name, the tier if the rows carry one, and
    the label of ``prediction_col`` as the cluster."""
    tier = tier_col if tier_col in numbered.columns else None
    carried = [c for c in passthrough if c not in (*columns, tier)]
    return numbered.select(
        F.col(id_col).cast("long").alias("id"),
        feature_array(columns).alias("vector"),
        payload(columns, tier, prediction_col, carried).alias("payload"),
    )


def batch_counts(points: DataFrame, batch_size: int = 512) -> DataFrame:
    """Points per upsert batch, by id."""
    return points.groupBy(batch_number("id", batch_size).alias("batch")).agg(
        F.count("*").alias("points")
    )
