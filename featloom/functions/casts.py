"""Text or number to double, and the schema that goes with it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def to_double(column: str | Column, strict: bool = False) -> Column:
    """Double value of a column; what is not a number gives null.

    With ``strict`` such a value fails the query instead (under ANSI mode,
    which is Spark 4's default).
    """
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("double") if strict else value.try_cast("double")


def doubles(columns: Iterable[str], strict: bool = False) -> list[Column]:
    """One double column for each name, under the same name."""
    return [to_double(c, strict).alias(c) for c in columns]


def feature_schema(columns: Iterable[str]) -> StructType:
    """Nullable double for each configured column, in order."""
    return StructType([StructField(c, DoubleType(), True) for c in columns])
