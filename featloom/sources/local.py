"""Small tables made on the driver."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ARROW_TYPES = {
    "string": pa.string(),
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "array<double>": pa.list_(pa.float64()),
}


def small_table(
    spark: SparkSession, fields: Mapping[str, str], rows: Iterable[Sequence]
) -> DataFrame:
    """A few rows as part of the plan itself. Unlike a table made from a list,
    it is not split into as many tasks as the cluster has cores."""
    records = [dict(zip(fields, row)) for row in rows]
    schema = pa.schema([(name, _ARROW_TYPES[kind]) for name, kind in fields.items()])
    return spark.createDataFrame(pa.Table.from_pylist(records, schema))
