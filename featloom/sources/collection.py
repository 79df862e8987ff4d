"""Named collections of points, kept as Parquet tables under one root.

Each collection has a small registry of its own, a file per change; the newest tells
its settings, its size and its block table. The block table lists the stored files,
each a block of points sorted by id, with count and smallest and largest id. A change
writes new blocks to a fresh folder, then a block table that names them and the old
blocks that stay, then the registry file. So a reader keeps the version it opened,
however many changes follow, and never sees a half-written one. Registry files are
numbered and created only if absent, so of two writers that start from one version
the second to commit fails. That is as safe as the file system's exclusive create:
HDFS and local disks have it, object stores if they support conditional writes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from featloom.functions.casts import to_double
from featloom.operators.unique import id_ranges, repeated_ids
from featloom.sources.local import small_table

_REGISTRY_FIELDS = {
    "name": "string",
    "version": "long",
    "vector_size": "int",
    "distance": "string",
    "block_size": "long",
    "points_count": "long",
    "min_id": "long",
    "max_id": "long",
    "block_table": "string",
    "point_schema": "string",
}
_REGISTRY_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _REGISTRY_FIELDS.items())
_BLOCK_FIELDS = {"path": "string", "points": "long", "min_id": "long", "max_id": "long"}
_BLOCK_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _BLOCK_FIELDS.items())
# Points per block at most: some hundred megabytes of narrow points.
_BLOCK_SIZE = 4_000_000


@dataclass(frozen=True)
class CollectionInfo:
    name: str
    version: int
    vector_size: int
    distance: str
    block_size: int
    points_count: int = 0
    min_id: int | None = None
    max_id: int | None = None
    block_table: str | None = None
    point_schema: str | None = None

    @property
    def dense(self) -> bool:
        """Whether the ids, which are unique, have no gaps."""
        return self.points_count > 0 and self.max_id - self.min_id + 1 == self.points_count


@dataclass(frozen=True)
class Page:
    """Points (id, payload) in id order, and the id the next page starts with: None
    after the last."""

    points: Sequence[Row]
    next_offset: int | None


@dataclass(frozen=True)
class Collection:
    """One version of a collection, for reading. ``blocks`` has a row per stored
    file, some 200 bytes each."""

    spark: SparkSession
    info: CollectionInfo
    blocks: Sequence[Row]

    def _read(self, blocks: Sequence[Row]) -> DataFrame:
        schema = StructType.fromJson(json.loads(self.info.point_schema))
        return self.spark.read.schema(schema).parquet(*[b["path"] for b in blocks])

    @property
    def points(self) -> DataFrame:
        """All points: id, vector, payload."""
        return self._read(self.blocks)

    def scan(
        self, columns: Sequence[str], strict: bool = False, passthrough: Sequence[str] = ()
    ) -> DataFrame:
        """The named payload fields of all points, as doubles, and any others as
        they are. Only these fields are read from storage."""
        fields = [to_double(F.col(f"payload.{c}"), strict).alias(c) for c in columns]
        carried = [F.col(f"payload.{c}") for c in passthrough if c not in columns]
        return self.points.select(*fields, *carried)

    def scroll(self, limit: int = 1000, offset: int | None = None) -> DataFrame:
        """One page: ``limit`` points from id ``offset`` on, in id order, with
        payload and without vector."""
        return self._from(offset, limit).select("id", "payload").orderBy("id").limit(limit)

    def page(self, limit: int = 1000, offset: int | None = None) -> Page:
        """One page, read, with the id the next one starts with: that of the one row
        more that is asked for. One job, whether the ids have gaps or not."""
        rows = self._first(("id", "payload"), limit + 1, offset)
        return Page(rows[:limit], rows[limit]["id"] if len(rows) > limit else None)

    def cursor(self, limit: int = 1000) -> Iterator[Page]:
        """Page after page to the end, each read when it is asked for."""
        offset: int | None = self.info.min_id
        while offset is not None:
            page = self.page(limit, offset)
            yield page
            offset = page.next_offset

    def next_offset(self, limit: int = 1000, offset: int | None = None) -> int | None:
        """Id the page after starts with, or None after the last one."""
        if self.info.dense:
            following = self._start(offset) + limit
            return following if following <= self.info.max_id else None
        rows = self._first(("id",), limit + 1, offset)
        return rows[limit]["id"] if len(rows) > limit else None

    def pages(self, limit: int = 1000) -> Iterator[DataFrame]:
        """Page after page to the end, unread: for work on executors."""
        offset: int | None = self.info.min_id
        while offset is not None:
            yield self.scroll(limit, offset)
            offset = self.next_offset(limit, offset)

    def _first(self, columns: Sequence[str], limit: int, offset: int | None) -> list[Row]:
        """The first ``limit`` points from the offset on. The range read is as long
        as, by the blocks' counts, so many ids need; only if it holds fewer points is
        a longer one read."""
        start = self._start(offset)
        sure = self._end(start, limit)
        reach = min(self._likely_end(start, limit), sure)
        while True:
            rows = self._between(start, reach).select(*columns).orderBy("id").limit(limit).collect()
            if len(rows) == limit or reach >= sure:
                return rows
            reach = min(start + 8 * (reach - start + 1), sure)

    def _start(self, offset: int | None) -> int:
        return self.info.min_id if offset is None else max(offset, self.info.min_id)

    def _from(self, offset: int | None, limit: int) -> DataFrame:
        """The points from the offset on, up to an id by which ``limit`` of them are
        sure to be found."""
        start = self._start(offset)
        return self._between(start, self._end(start, limit))

    def _between(self, start: int, end: int) -> DataFrame:
        """The points of an id range. Blocks it does not meet are never opened."""
        needed = [b for b in self.blocks if b["max_id"] >= start and b["min_id"] <= end]
        if not needed:
            return self._read(self.blocks[:1]).where(F.lit(False))
        return self._read(needed).where(F.col("id").between(start, end))

    def _end(self, start: int, limit: int) -> int:
        """An id by which ``limit`` points from ``start`` on are sure to be found. It
        follows from the block table alone. Blocks may overlap."""
        if self.info.dense:
            return min(self.info.max_id, start + limit - 1)
        sure = 0
        for block in sorted((b for b in self.blocks if b["max_id"] >= start), key=lambda b: b["max_id"]):
            sure += block["points"] if block["min_id"] >= start else 0
            if sure >= limit:
                return block["max_id"]
        return self.info.max_id

    def _likely_end(self, start: int, limit: int) -> int:
        """An id by which there should be half as many points again as ``limit``, if
        the ids of each block are spread evenly."""
        wanted, end = 1.5 * limit + 16, start
        for block in sorted((b for b in self.blocks if b["max_id"] >= start), key=lambda b: b["min_id"]):
            first = max(start, block["min_id"])
            apart = (block["max_id"] - block["min_id"] + 1) / block["points"]
            held = (block["max_id"] - first + 1) / apart
            if held >= wanted:
                return max(end, first + int(wanted * apart))
            wanted -= held
            end = max(end, block["max_id"])
        return end


class CollectionStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- registry -------------------------------------------------------

    def _registry_path(self, name: str | None = None) -> str:
        base = f"{self.root}/_collections"
        return base if name is None else f"{base}/collection={quote(name, safe='')}"

    def changes(self, name: str | None = None) -> DataFrame:
        """All registry rows, old and current, of one collection or of all."""
        try:
            rows = self.spark.read.schema(_REGISTRY_SCHEMA).option("mode", "DROPMALFORMED")
            return rows.json(self._registry_path(name)).select(*_REGISTRY_FIELDS)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return small_table(self.spark, _REGISTRY_FIELDS, [])

    def registry(self) -> DataFrame:
        """The current row of every collection."""
        newest = F.max_by(F.struct("*"), "version").alias("newest")
        return self.changes().groupBy("name").agg(newest).select("newest.*")

    def list_collections(self) -> DataFrame:
        return self.registry().select("name").orderBy("name")

    def find(self, name: str) -> CollectionInfo | None:
        """The newest change of a collection. A file that its writer has not finished
        is no change yet."""
        for version in sorted(self._versions(name), reverse=True):
            files, place = self._file(f"{self._registry_path(name)}/version-{version}.json")
            stream = files.open(place)
            try:
                written = bytes(stream.readAllBytes())
            finally:
                stream.close()
            if written.endswith(b"\n"):
                return CollectionInfo(**json.loads(written))
        return None

    def _file(self, path: str):
        """The Hadoop file system of a path, and the path as it takes it."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _versions(self, name: str) -> list[int]:
        """Numbers of the registry files, finished or not."""
        files, place = self._file(self._registry_path(name))
        if not files.exists(place):
            return []
        names = [entry.getPath().getName() for entry in files.listStatus(place)]
        return [int(n[8:-5]) for n in names if n.startswith("version-") and n.endswith(".json")]

    def info(self, name: str) -> CollectionInfo:
        found = self.find(name)
        if found is None:
            raise LookupError(f"no collection named {name}")
        return found

    def exists(self, name: str) -> bool:
        return self.find(name) is not None

    def has_data(self, name: str) -> bool:
        found = self.find(name)
        return found is not None and found.points_count > 0

    def open(self, name: str) -> Collection:
        """The collection as it is now, for reading. No data is an error."""
        info = self.info(name)
        if info.points_count == 0:
            raise ValueError(f"no data in collection {name}")
        return Collection(self.spark, info, self._blocks(info))

    def _blocks(self, info: CollectionInfo) -> list[Row]:
        if info.block_table is None:
            return []
        return self.spark.read.schema(_BLOCK_SCHEMA).parquet(info.block_table).orderBy("min_id").collect()

    def _commit(self, info: CollectionInfo) -> CollectionInfo:
        """Makes ``info`` the newest row. Its number must be free: creating the file
        is the one step that decides between two writers."""
        files, place = self._file(f"{self._registry_path(info.name)}/version-{info.version}.json")
        try:
            stream = files.create(place, False)
        except Py4JJavaError as error:
            if not files.exists(place):
                raise
            raise RuntimeError(
                f"collection {info.name} was changed by another writer, or one ended "
                f"while it wrote {place.toString()}, which is then to be removed"
            ) from error
        try:
            row = {name: value for name, value in vars(info).items() if value is not None}
            stream.write(bytearray(json.dumps(row).encode() + b"\n"))
        finally:
            stream.close()
        return info

    # --- writing --------------------------------------------------------

    def _fresh_path(self, name: str, kind: str) -> str:
        return f"{self.root}/{name}/{kind}-{uuid.uuid4().hex}"

    def _remove(self, path: str) -> None:
        files, place = self._file(path)
        files.delete(place, True)

    @contextmanager
    def staging(self, name: str) -> Iterator[str]:
        """A path for an intermediate table, removed at the end."""
        path = self._fresh_path(name, "staging")
        try:
            yield path
        finally:
            self._remove(path)

    def _replace(
        self,
        info: CollectionInfo,
        points: DataFrame,
        together: bool,
        stay: Sequence[Row] = (),
    ) -> CollectionInfo:
        """Write the points as new blocks and make them, with the blocks that
        ``stay``, the current contents.

        ``together`` says that near ids are in the same partitions already.
        Otherwise one shuffle by id range sees to it. Ids have to be unique, which
        is looked up in the ids just stored.
        """
        path = self._fresh_path(info.name, "points")
        # A vector of another size fails the write itself.
        message = F.concat(
            F.lit("vector size "), F.size("vector"), F.lit(f" instead of {info.vector_size}")
        )
        right_size = F.when(F.size("vector") == info.vector_size, F.col("vector"))
        checked = (points if together else points.repartitionByRange("id")).withColumn(
            "vector", right_size.otherwise(F.raise_error(message))
        )
        (
            checked.sortWithinPartitions("id")
            .write.option("maxRecordsPerFile", info.block_size)
            .parquet(path)
        )
        ranges = id_ranges(self.spark, path, points.select("id").schema)
        if repeated_ids(self.spark, ranges, points.select("id").schema):
            self._remove(path)
            raise ValueError("a point id occurs more than once")
        new = [(r["path"], r["points"], r["min_id"], r["max_id"]) for r in ranges]
        blocks = new + [tuple(b) for b in stay]
        table = self._fresh_path(info.name, "blocks")
        small_table(self.spark, _BLOCK_FIELDS, blocks).coalesce(1).write.parquet(table)
        return self._commit(
            replace(
                info,
                version=info.version + 1,
                points_count=sum(b[1] for b in blocks),
                min_id=min((b[2] for b in blocks), default=None),
                max_id=max((b[3] for b in blocks), default=None),
                block_table=table,
                point_schema=checked.schema.json(),
            )
        )

    def recreate(
        self,
        name: str,
        vector_size: int,
        distance: str = "Cosine",
        points: DataFrame | None = None,
        together: bool = False,
        block_size: int = _BLOCK_SIZE,
    ) -> CollectionInfo:
        """A new collection of that name in place of any old one: empty, or with
        the points given, which then appear in the same change. Of what was there
        before, the last version stays on disk for its readers."""
        old = self.find(name)
        version = old.version if old else 0
        fresh = CollectionInfo(name, version, vector_size, distance, block_size)
        if points is None:
            made = self._commit(replace(fresh, version=version + 1))
        else:
            made = self._replace(fresh, points, together)
        self._prune(made, old)
        return made

    def _prune(self, *versions: CollectionInfo | None) -> None:
        """Remove what none of these versions of a collection names."""
        named = {v.block_table for v in versions if v and v.block_table}
        for v in versions:
            named.update(b["path"].rpartition("/")[0] for b in (self._blocks(v) if v else ()))
        files, place = self._file(f"{self.root}/{versions[0].name}")
        if not files.exists(place):
            return
        keep = {path.rpartition("/")[2] for path in named}
        for entry in files.listStatus(place):
            kind = entry.getPath().getName()
            if kind.startswith(("points-", "blocks-")) and kind not in keep:
                files.delete(entry.getPath(), True)

    def delete(self, name: str) -> bool:
        """Remove a collection's points and registry; whether there was one."""
        found = self.exists(name)
        self._remove(self._registry_path(name))
        self._remove(f"{self.root}/{name}")
        return found

    def write_points(self, name: str, points: DataFrame, together: bool = False) -> CollectionInfo:
        """Make the points the whole contents. All tasks write at once; nothing
        passes the driver. With ``together`` the partitions stay as they are,
        which suits numbered rows."""
        return self._replace(self.info(name), points, together)

    def upsert(self, name: str, points: DataFrame) -> CollectionInfo:
        """Insert points, replacing those with the same id.

        Only blocks in whose id range a new id lies are read and written again, in
        one shuffle with the new points; all others stay as they are. Ids have to
        be unique among the new.
        """
        info = self.info(name)
        with self.staging(name) as path:
            points.write.parquet(path)
            new = self.spark.read.parquet(path)
            if not new.groupBy("id").count().where("count > 1").isEmpty():
                raise ValueError("a point id occurs more than once among the new points")
            if info.points_count == 0:
                return self._replace(info, new, together=False)
            blocks = self._blocks(info)
            touched = set(self._touched(new, blocks))
            stay = [b for i, b in enumerate(blocks) if i not in touched]
            again = [b for i, b in enumerate(blocks) if i in touched]
            schema = StructType.fromJson(json.loads(info.point_schema))
            old = self.spark.read.schema(schema)
            # Without a touched block the stored schema still has to be met.
            rows = old.parquet(*[b["path"] for b in again]) if again else old.parquet(blocks[0]["path"]).where(F.lit(False))
            return self._replace(info, self.merge_many(rows, new), together=True, stay=stay)

    @staticmethod
    def _touched(new: DataFrame, blocks: Sequence[Row]) -> list[int]:
        """Positions of the blocks in whose range any of the ids lies."""
        low = np.array([b["min_id"] for b in blocks], np.int64)
        high = np.array([b["max_id"] for b in blocks], np.int64)

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = np.sort(batch.column(0).to_numpy(zero_copy_only=False))
                hit = np.searchsorted(ids, low) < np.searchsorted(ids, high, side="right")
                yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(hit))], ["block"])

        found = new.select(F.col("id").cast("long")).mapInArrow(meet, "block long").distinct()
        return [r["block"] for r in found.collect()]

    @staticmethod
    def merge_many(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.withColumn("_round", F.lit(0)).unionByName(
            new.withColumn("_round", F.lit(1)), allowMissingColumns=True
        )
        latest = Window.partitionBy("id").orderBy(F.desc("_round"))
        return (
            both.repartitionByRange("id")
            .withColumn("_place", F.row_number().over(latest))
            .where("_place = 1")
            .drop("_round", "_place")
        )
