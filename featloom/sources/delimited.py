"""Delimited text with a header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from featloom.functions.casts import doubles


def read_delimited(
    spark: SparkSession,
    path: str,
    separator: str = "\t",
    schema: StructType | str | None = None,
    infer_types: bool = False,
    **options: str,
) -> DataFrame:
    """Scan the text. Without a schema all columns are strings, which costs no
    pass over the data; inferring types reads the whole text once more."""
    reader = spark.read.options(header=True, sep=separator, inferSchema=infer_types, **options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def load_features(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    separator: str = "\t",
    passthrough: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """The feature columns as doubles, without rows that lack a usable number.

    Text that is not a number counts as missing. The parser skips the columns
    that are not asked for.
    """
    raw = read_delimited(spark, path, separator, **options)
    carried = [c for c in passthrough if c not in columns]
    return raw.select(*doubles(columns), *carried).na.drop("any", subset=list(columns))
