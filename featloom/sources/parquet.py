"""Parquet in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace whatever is at the path."""
    df.write.mode("overwrite").parquet(path)


def write_counted(df: DataFrame, path: str) -> int:
    """Writes like ``write_parquet`` and tells the rows, counted as they are written.
    The writing tasks count, each once however often it is tried."""
    written = Observation("written")
    write_parquet(df.observe(written, F.count(F.lit(1)).alias("rows")), path)
    return written.get.get("rows", 0)
