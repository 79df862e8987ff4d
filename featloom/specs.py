"""Settings of each step, as plain frozen dataclasses."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# The default columns, bounds, cut points and names have to be
# these for results to agree with what existing users of the product table have.
DEFAULT_COLUMNS = (
    "energy_100g",
    "fat_100g",
    "carbohydrates_100g",
    "sugars_100g",
    "proteins_100g",
)
DEFAULT_UPPER_BOUNDS = {
    "energy_100g": 5000.0,
    "fat_100g": 100.0,
    "carbohydrates_100g": 100.0,
    "sugars_100g": 100.0,
    "proteins_100g": 100.0,
}
DEFAULT_INPUT_COLLECTION = "products_raw"
DEFAULT_OUTPUT_COLLECTION = "products_clustered"


@dataclass(frozen=True)
class BandSpec:
    """Two quantiles per column; rows outside any of the bands are dropped.

    ``relative_error`` is the allowed rank error. At an error as large as the
    lower quantile the bounds are the minimum and maximum; 0 asks for exact
    quantiles.
    """

    lower: float = 0.01
    upper: float = 0.99
    relative_error: float = 0.01


@dataclass(frozen=True)
class TierSpec:
    """Below ``low_below`` is low, up to and with ``medium_upto`` medium, else high."""

    column: str = "energy_100g"
    low_below: float = 150.0
    medium_upto: float = 350.0
    output: str = "energy_tier"
    labels: tuple[str, str, str] = ("low", "medium", "high")


@dataclass(frozen=True)
class CleanSpec:
    columns: tuple[str, ...] = DEFAULT_COLUMNS
    upper_bounds: Mapping[str, float] = field(default_factory=lambda: dict(DEFAULT_UPPER_BOUNDS))
    band: BandSpec | None = BandSpec()
    tier: TierSpec | None = TierSpec()
    # None keeps every row; a limit needs order_by, the key that says which stay.
    row_limit: int | None = None
    order_by: tuple[str, ...] = ()
    # Columns carried along untouched: row keys, anything to be published later.
    passthrough: tuple[str, ...] = ()


@dataclass(frozen=True)
class ClusterSpec:
    k: int = 5
    seed: int = 51
    max_iter: int = 20
    tol: float = 1e-4
    # Partitions to fit in; None: as stored, or by the number of rows if there are many.
    # A fit depends on how rows are split, so the number is never the cluster's.
    partitions: int | None = None
    features_col: str = "features"
    scaled_features_col: str = "scaled_features"
    prediction_col: str = "prediction"
    # Columns of the input to keep in the predictions besides the features.
    passthrough: tuple[str, ...] = ()


@dataclass(frozen=True)
class CollectionSpec:
    root: str
    input_name: str = DEFAULT_INPUT_COLLECTION
    output_name: str = DEFAULT_OUTPUT_COLLECTION
    distance: str = "Cosine"
    # Only says what batch_counts reports; writing is by partition.
    batch_size: int = 512


@dataclass(frozen=True)
class PipelineSpec:
    """Everything the jobs need. Paths have to be on storage all executors see."""

    source_path: str
    preprocessed_path: str
    predictions_path: str
    model_path: str
    collections: CollectionSpec
    separator: str = "\t"
    clean: CleanSpec = CleanSpec()
    cluster: ClusterSpec = ClusterSpec()
