"""Squared Euclidean distances and the nearest centre.

Two forms. Over scalar columns the arithmetic is written out, so that it becomes
part of the stage's generated code; that suits the handful of columns of a
feature table. With many columns and centres such code grows too large for the
JVM to compile and gets far slower than anything else, so wide vectors are
labelled by numpy in Arrow batches instead. Both add up coordinate by coordinate,
so they give the same bits, and in both a row with a null or NaN coordinate has
neither label nor distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

Centers = Sequence[Sequence[float]]

# Largest number of columns times centres that is written out.
WRITTEN_OUT_TERMS = 64


def feature_array(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c) for c in columns])


def written_out(columns: Sequence[str], centers: Sequence) -> bool:
    return len(columns) * len(centers) <= WRITTEN_OUT_TERMS


def squared_distance(columns: Sequence[str], center: Sequence[float]) -> Column:
    if len(columns) != len(center):
        raise ValueError(f"centre has {len(center)} values for {len(columns)} columns")
    differences = [F.col(c) - F.lit(float(x)) for c, x in zip(columns, center)]
    return reduce(add, [d * d for d in differences])


def squared_distances(columns: Sequence[str], centers: Centers) -> Column:
    """Array of the distances to each centre, in order."""
    return F.array(*[squared_distance(columns, c) for c in centers])


def present(columns: Sequence[str]) -> Column:
    """Whether no column is null or NaN."""
    return reduce(and_, [F.col(c).isNotNull() & ~F.isnan(c) for c in columns])


def index_of_smallest(array_col: str) -> Column:
    """Position from 0 of the smallest element; on a tie the lowest position.

    Takes a column by name: as a column of its own, the array is computed once.
    """
    return (F.array_position(array_col, F.array_min(array_col)) - 1).cast("int")


def summed(terms: Iterable[np.ndarray]) -> np.ndarray:
    """Added up one after the other, as generated code does; numpy's own sum
    pairs terms and may differ in the last bits."""
    return reduce(add, terms)


def as_matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Arrow lists of doubles, all of one width, as the rows of a matrix, without a
    Python object per row. Null elements become NaN; null lists have no row."""
    values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return values.reshape(len(vectors) - vectors.null_count, width)


def nearest_in_batches(vector: Column, centers: Centers) -> Column:
    """Struct of the nearest centre's index and its squared distance, for an
    array column of any width. A null vector, and one with a null or NaN
    element, gives null."""
    points = np.array(centers, dtype="float64")

    @F.arrow_udf("cluster int, distance double")
    def nearest(vectors: pa.Array) -> pa.Array:
        x = as_matrix(vectors, points.shape[1])
        known = ~np.isnan(x).any(axis=1)
        best = np.full(len(x), np.inf)
        label = np.zeros(len(x), np.int32)
        # One centre at a time keeps the batch's working memory at its own size.
        for k, p in enumerate(points):
            distance = summed((x[:, i] - c) ** 2 for i, c in enumerate(p))
            closer = distance < best
            label[closer], best[closer] = k, distance[closer]
        # Back to one entry per vector, those without an answer null.
        place = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))[known]
        missing = np.ones(len(vectors), bool)
        missing[place] = False
        fields = []
        for values, kind in ((label, np.int32), (best, np.float64)):
            spread = np.zeros(len(vectors), kind)
            spread[place] = values[known]
            fields.append(pa.array(spread, mask=missing))
        return pa.StructArray.from_arrays(fields, names=["cluster", "distance"])

    return nearest(vector)
