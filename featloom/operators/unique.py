"""Whether ids occur more than once in files that are each sorted by id.

Only ids that two files, or two parts of them, may share are ever shuffled. A file
whose ids go up by one from row to row has no id twice, which one aggregate over the
files tells. In any other file equal ids are neighbours, found as the file is read in
order; what is read in one go is a strictly rising run. So an id that occurs twice
lies where two runs overlap, and only ids of such ranges are grouped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

# Ranges that a filter names; with more, those closest together become one.
_MOST_RANGES = 64


def id_ranges(spark: SparkSession, path: str, schema: StructType) -> list[Row]:
    """Per Parquet file: path, points, min_id, max_id, and whether ids go up by one
    from row to row. A row without id is an error. Only the ids are read."""
    stored = spark.read.schema(schema).parquet(path)
    ahead = F.col("id") - F.col("_metadata.row_index")
    files = (
        stored.groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(
            F.count("*").alias("points"),
            F.count("id").alias("known"),
            F.min("id").cast("long").alias("min_id"),
            F.max("id").cast("long").alias("max_id"),
            (F.min(ahead) == F.max(ahead)).alias("steady"),
        )
        .collect()
    )
    if any(f["known"] < f["points"] for f in files):
        raise ValueError("a point has no id")
    return files


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strictly rising runs of a task's ids (id, row of its file), and whether one
    ended because the next id is the same. A run ends with its file."""
    first = last = None
    for batch in batches:
        ids, rows = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(ids):
            continue
        if last is None:
            first = ids[0]
        else:
            ids, rows = np.concatenate([[last[0]], ids]), np.concatenate([[last[1]], rows])
        step = np.diff(ids)
        cuts = np.flatnonzero((step <= 0) | (np.diff(rows) != 1))
        starts = np.concatenate([[first], ids[cuts + 1]])
        if len(cuts):
            yield _as_batch(starts[:-1], ids[cuts], step[cuts] == 0)
        first, last = starts[-1], (ids[-1], rows[-1])
    if last is not None:
        yield _as_batch([first], [last[0]], [False])


def _as_batch(low, high, repeated) -> pa.RecordBatch:
    columns = [pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(repeated, pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, ["low", "high", "repeated"])


def shared_ranges(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that hold whatever lies in two or more of the given ones, in order and
    apart from each other."""
    shared: list[list[int]] = []
    reach = None
    for low, high in sorted(ranges):
        if reach is not None and low <= reach:
            end = min(high, reach)
            if shared and low <= shared[-1][1]:
                shared[-1][1] = max(shared[-1][1], end)
            else:
                shared.append([low, end])
        reach = high if reach is None else max(reach, high)
    if len(shared) > _MOST_RANGES:
        gaps = sorted(range(1, len(shared)), key=lambda i: shared[i][0] - shared[i - 1][1])
        starts = [0, *sorted(gaps[len(shared) - _MOST_RANGES :])]
        shared = [[shared[a][0], shared[b - 1][1]] for a, b in zip(starts, [*starts[1:], len(shared)])]
    return [(low, high) for low, high in shared]


def _grouped(spark: SparkSession, files: Sequence[Row], ranges: Sequence[tuple[int, int]], schema: StructType) -> DataFrame:
    """Ids of the ranges that occur more than once: the one shuffle."""
    met = [f["path"] for f in files if any(f["min_id"] <= b and a <= f["max_id"] for a, b in ranges)]
    inside = reduce(or_, [F.col("id").between(a, b) for a, b in ranges])
    return spark.read.schema(schema).parquet(*met).where(inside).groupBy("id").count().where("count > 1")


def repeated_ids(spark: SparkSession, files: Sequence[Row], schema: StructType) -> bool:
    """Whether an id occurs twice in the files that ``id_ranges`` tells of, each
    sorted by id. What comes to the driver is a row per file and task."""
    ranges = [(f["min_id"], f["max_id"]) for f in files if f["steady"]]
    spread = [f["path"] for f in files if not f["steady"]]
    if spread:
        ids = spark.read.schema(schema).parquet(*spread).select(F.col("id").cast("long"), "_metadata.row_index")
        runs = ids.mapInArrow(_runs, "low long, high long, repeated boolean").collect()
        if any(r["repeated"] for r in runs):
            return True
        ranges += [(r["low"], r["high"]) for r in runs]
    shared = shared_ranges(ranges)
    return bool(shared) and not _grouped(spark, files, shared, schema).isEmpty()
