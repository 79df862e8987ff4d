"""Mean silhouette with squared Euclidean distance, in two passes.

With squared distances the mean distance of a row to a cluster follows from the
cluster's size, sum and sum of squares, so no pair of rows is ever formed. For
a row x and a cluster of n rows with squared norms adding up to q and vectors
adding up to y, the mean is |x|^2 + q/n - 2 x.y/n.

Rows without a label or with a missing value are left out by aggregates that skip
nulls, not by a filter: labels are often computed in the same plan, and a filter on
one is pushed below it, where it computes every distance again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F

from featloom.functions.vectors import as_matrix, feature_array, present, summed, written_out

# Clusters a score may have; a row of each comes to the driver.
MAX_CLUSTERS = 10_000


def _sum(terms: Sequence[Column]) -> Column:
    return reduce(add, terms)


def _squared_norm(columns: Sequence[str]) -> Column:
    return _sum([F.col(c) * F.col(c) for c in columns])


def cluster_moments(
    predictions: DataFrame, columns: Sequence[str], prediction_col: str = "prediction"
) -> DataFrame:
    """Size, sum of squared norms and sum per column of each cluster, over its rows
    without missing values. Rows without a label make a group of their own."""
    norm = F.when(present(columns), _squared_norm(columns)).alias("_norm")
    rows = predictions.select(F.col(prediction_col).alias("cluster"), *columns, norm)
    whole = F.col("_norm").isNotNull()
    return rows.groupBy("cluster").agg(
        F.count("_norm").alias("size"),
        F.sum("_norm").alias("squares"),
        *[F.sum(F.when(whole, F.col(c))).alias(f"sum_{i}") for i, c in enumerate(columns)],
    )


def _moments(predictions: DataFrame, columns: Sequence[str], prediction_col: str) -> list[Row]:
    """The clusters that have rows without missing values."""
    rows = cluster_moments(predictions, columns, prediction_col).limit(MAX_CLUSTERS + 2).collect()
    found = [m for m in rows if m["cluster"] is not None and m["size"]]
    if len(rows) > MAX_CLUSTERS + 1:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    if len(found) < 2:
        raise ValueError("a silhouette needs at least two clusters")
    return found


def silhouette(
    predictions: DataFrame, columns: Sequence[str], prediction_col: str = "prediction"
) -> DataFrame:
    """One row with the mean silhouette of the labelled rows without missing values.
    The moments, one row per cluster, go into the second pass as literals or, with
    many columns and clusters, to numpy in Arrow batches; the sums are the same."""
    moments = _moments(predictions, columns, prediction_col)

    def mean_distance(m: Row) -> Column:
        dot = _sum([F.col(c) * (m[f"sum_{i}"] / m["size"]) for i, c in enumerate(columns)])
        return F.col("_norm") + F.lit(m["squares"] / m["size"]) - dot * 2.0

    def own_mean(i: int, m: Row) -> Column:
        # A row is not its own neighbour: its cluster's mean is over size - 1 rows.
        mean = F.col(f"_mean_{i}")
        return F.when(_is(m), mean * (m["size"] / (m["size"] - 1)) if m["size"] > 1 else F.lit(0.0))

    def _is(m: Row) -> Column:
        return F.col(prediction_col) == m["cluster"]

    norm = F.when(present(columns), _squared_norm(columns)).alias("_norm")
    rows = predictions.select(prediction_col, *columns, norm)
    if written_out(columns, moments):
        means = [mean_distance(m) for m in moments]
    else:
        rows = rows.select(prediction_col, "_norm", _means_in_batches(columns, moments).alias("_means"))
        means = [F.col("_means")[i] for i in range(len(moments))]
    # Without a label there is no mean of one's own, with a missing value none at all.
    own = F.coalesce(*[own_mean(i, m) for i, m in enumerate(moments)])
    other = F.least(*[F.when(~_is(m), F.col(f"_mean_{i}")) for i, m in enumerate(moments)])
    alone = F.col(prediction_col).isin([m["cluster"] for m in moments if m["size"] == 1])
    a, b = F.col("own"), F.col("other")
    score = (
        F.when(F.col("alone") | (a == b), 0.0).when(a < b, 1 - a / b).otherwise(b / a - 1)
    )
    return (
        rows.select(prediction_col, "_norm", *[x.alias(f"_mean_{i}") for i, x in enumerate(means)])
        .select("_norm", own.alias("own"), other.alias("other"), alone.alias("alone"))
        .agg(F.avg(F.when(a.isNotNull() & F.col("_norm").isNotNull(), score)).alias("silhouette"))
    )


def _means_in_batches(columns: Sequence[str], moments: Sequence[Row]) -> Column:
    """Array of the mean distances to the clusters, in their order; of no use for a row
    with a missing value."""
    centers = [[m[f"sum_{i}"] / m["size"] for i in range(len(columns))] for m in moments]
    squares = [m["squares"] / m["size"] for m in moments]

    @F.arrow_udf("array<double>")
    def means(vectors: pa.Array, norms: pa.Array) -> pa.Array:
        x, norm = as_matrix(vectors, len(columns)), norms.to_numpy(zero_copy_only=False)
        found = np.empty((len(x), len(centers)))
        for k, (center, q) in enumerate(zip(centers, squares)):
            found[:, k] = norm + q - summed(x[:, i] * c for i, c in enumerate(center)) * 2.0
        ends = np.arange(len(x) + 1, dtype=np.int32) * len(centers)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.reshape(-1)))

    return means(feature_array(columns), F.col("_norm"))
