"""Row conditions of the cleaning steps, over any set of numeric columns.

They are plain comparisons joined by AND, so Catalyst merges them into one
filter and pushes them to a Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def all_present(columns: Iterable[str]) -> Column:
    """No null and no NaN. Written so it can be counted as well as filtered on."""
    return _all(F.col(c).isNotNull() & ~F.isnan(c) for c in columns)


def all_non_negative(columns: Iterable[str]) -> Column:
    return _all(F.col(c) >= 0 for c in columns)


def all_below(upper_bounds: Mapping[str, float]) -> Column:
    """Every bounded column strictly below its bound."""
    return _all(F.col(c) < bound for c, bound in upper_bounds.items())


def all_within(bounds: Mapping[str, tuple[float, float]]) -> Column:
    """Every column inside its band, both ends included."""
    return _all(F.col(c).between(low, high) for c, (low, high) in bounds.items())
