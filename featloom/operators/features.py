"""Feature vectors and standardisation.

The ML form (vector column, fitted model) is what clustering uses. The column
form gives the same numbers as ordinary double columns, for SQL and for storage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from featloom.functions.vectors import feature_array


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Add the columns as one ML vector. Null or NaN input fails the query."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def assemble_array(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Add the columns as one array, the form to store or to read from SQL."""
    return df.withColumn(output, feature_array(columns))


def feature_pipeline(
    columns: Sequence[str],
    features_col: str = "features",
    scaled_features_col: str = "scaled_features",
) -> Pipeline:
    """Assembler, then scaler to zero mean and unit sample deviation."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(columns), outputCol=features_col),
            StandardScaler(
                inputCol=features_col,
                outputCol=scaled_features_col,
                withMean=True,
                withStd=True,
            ),
        ]
    )


def fit_features(df: DataFrame, columns: Sequence[str], **names: str) -> PipelineModel:
    return feature_pipeline(columns, **names).fit(df)


def scaler_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation per column, one row each, in one pass."""
    aggregates = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
        )
        for c in columns
    ]
    return df.agg(F.array(*aggregates).alias("stats")).select(F.inline("stats"))


def scaler_values(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """The statistics as numbers: one job, one row per column to the driver."""
    rows = scaler_stats(df, columns).collect()
    return {r["column_name"]: (r["mean"], r["std"]) for r in rows}


def model_scaler(
    model: PipelineModel, columns: Sequence[str]
) -> dict[str, tuple[float, float]]:
    """The same numbers, taken from a fitted model."""
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    return {c: (float(m), float(s)) for c, m, s in zip(columns, scaler.mean, scaler.std)}


def standardise(
    df: DataFrame, stats: Mapping[str, tuple[float, float]], suffix: str = "_scaled"
) -> DataFrame:
    """Add (x - mean) / std per column; a column without spread gives 0, and a
    missing value stays missing."""

    def scaled(column: str, mean: float, std: float | None):
        if not std:
            missing = F.col(column).isNull() | F.isnan(column)
            return F.when(missing, F.col(column)).otherwise(F.lit(0.0)).cast("double")
        return (F.col(column) - F.lit(mean)) / F.lit(std)

    return df.withColumns({c + suffix: scaled(c, m, s) for c, (m, s) in stats.items()})
