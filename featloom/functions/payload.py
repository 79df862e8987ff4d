"""The fields stored with a point, as a typed struct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def payload(
    columns: Sequence[str],
    tier_col: str | None = None,
    prediction_col: str | None = None,
    passthrough: Sequence[str] = (),
) -> Column:
    """Feature values, then the tier and the cluster number where there are any."""
    fields = [F.col(c) for c in (*columns, *passthrough)]
    if tier_col is not None:
        fields.append(F.col(tier_col))
    if prediction_col is not None:
        fields.append(F.col(prediction_col).cast("int").alias("cluster"))
    return F.struct(*fields)


def batch_number(id_col: str, batch_size: int) -> Column:
    """Number of the upsert batch a point id belongs to."""
    return F.expr(f"`{id_col}` div {int(batch_size)}")
