"""Dense row ids 0..n-1 without a global window and without Python rows.

Rows are numbered by where they stand in a written Parquet table: the id is the
number of rows in the files before, plus the row's position in its own file. Files
are in order of the task number and roll-over number in their names, and told apart
by a hash of their paths, which costs a row less than a pattern. Counting reads no
data column and sorts nothing; the numbering itself is a broadcast join with 16 bytes per file, so
there is no shuffle, at any size (a million files are some 16 MB on each executor). Written files do not move, so a lost executor or a
retried task sees the same ids again.

Where rows are sorted, a task gets a bounded number of them, however many there are:
the partitions follow from the rows counted, not from the session's settings alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, functions as F

from featloom.sources.local import small_table

# Spark's own names: part-<task>-<job>[-c<roll>|.c<roll>].
_TASK = r"/part-(\d+)-[^/]*$"
_ROLL = r"[-.]c(\d+)[^/]*$"
# Rows that one task sorts at most, about: some hundred megabytes of narrow rows. Fewer
# if that takes no more partitions than a shuffle writes without keeping rows in memory.
ROWS_PER_TASK = 2_000_000
_FEW_ROWS, _FEW_PARTITIONS = 250_000, 192


def number_stored_rows(
    spark: SparkSession, path: str, id_col: str = "id", together: bool = False
) -> DataFrame:
    """Parquet table at ``path``, written by one Spark job, with ids in order of its
    files and their rows.

    Partitions are as they are read. ``together`` is for those who sort by id or
    store by it: if there are more than ``ROWS_PER_TASK`` rows, each partition gets
    at most that many ids in a row, in one shuffle.
    """
    stored = spark.read.parquet(path)
    columns = stored.columns
    if id_col in columns:
        raise ValueError(f"the table already has a column {id_col}")
    path_of = F.col("_metadata.file_path")
    placed = stored.select("*", F.xxhash64(path_of).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # One row per file comes to the driver, which has listed the files anyway. The path
    # is a key and no value: a text among the values would have all rows sorted.
    counted = (
        stored.groupBy(path_of.alias("path"))
        .agg(F.count("*").alias("rows"), F.max("_metadata.row_index").alias("last"))
        .select("*", F.xxhash64("path").alias("file"))
        .collect()
    )
    places = {r["path"]: (_number(_TASK, r["path"]), _number(_ROLL, r["path"])) for r in counted}
    whole = all(r["rows"] == r["last"] + 1 for r in counted)
    if (
        not whole
        or None in (p[0] for p in places.values())
        or len(set(places.values())) < len(places)
        or len({r["file"] for r in counted}) < len(places)
    ):
        raise ValueError(f"{path} is not the output of one Spark job")
    counted.sort(key=lambda r: (places[r["path"]][0], places[r["path"]][1] or 0))
    starts = accumulate((r["rows"] for r in counted), initial=0)
    offsets = small_table(
        spark, {"_of": "long", "_start": "long"}, [(r["file"], start) for r, start in zip(counted, starts)]
    )
    here = F.col("_file") == F.col("_of")
    numbered = placed.join(F.broadcast(offsets), here).select((F.col("_start") + F.col("_row")).alias(id_col), *columns)
    total = sum(r["rows"] for r in counted)
    if not together or total <= ROWS_PER_TASK:
        return numbered
    each = min(max(_FEW_ROWS, math.ceil(total / _FEW_PARTITIONS)), ROWS_PER_TASK)
    return numbered.repartitionById(math.ceil(total / each), F.floor(F.col(id_col) / each).cast("int"))


def _number(pattern: str, path: str) -> int | None:
    found = re.search(pattern, path)
    return int(found[1]) if found else None


def positioned(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The rows sorted by key, those of equal key in the order they are read.

    The position read at also counts in splitting the sort into partitions, so
    one key's rows, however many, are shared among tasks. If the session's shuffle
    partitions would get more than ``ROWS_PER_TASK`` rows each, there are more of them.
    """
    placed = df.withColumn("_position", F.monotonically_increasing_id())
    keys = [*order_by, "_position"]
    parts = math.ceil(df.count() / ROWS_PER_TASK)
    if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return placed.orderBy(*keys).drop("_position")
    return placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_position")


def dense_ids(
    df: DataFrame,
    staging_path: str,
    order_by: Sequence[str] = (),
    id_col: str = "id",
    together: bool = False,
) -> DataFrame:
    """Number any DataFrame, by key or, without one, in the order it is read.

    The rows are written to ``staging_path`` first (overwritten), sorted over
    all partitions if there is a key. ``together`` is as in ``number_stored_rows``.
    """
    rows = positioned(df, order_by) if order_by else df
    rows.write.mode("overwrite").parquet(staging_path)
    return number_stored_rows(df.sparkSession, staging_path, id_col, together)
