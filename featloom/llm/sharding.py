"""Shards of near equal size by sampled splitters.

Records are put in one order, by hash of the text, then id, so that a shard is a
random selection of texts and equal texts are neighbours. Then

1. a key row per record (hash, id, size) is stored; a sample of them is drawn with a
   chance in proportion to size, and its quantiles are the boundaries of many ranges;
2. every key row goes to its range, and the ranges' exact sizes are summed. A range
   that is overfull, of several records, gets boundaries of its own from a sample
   within it, until none is. As boundaries are whole keys (hash, id, row), one hot text
   is cut like any other run of records;
3. within each range, running sums of rows and bytes, added to what the ranges before
   hold, give each record its place in the whole order. A shard is an equal part of the
   bytes; equal texts that a cut would part stay together, in the shard their middle
   lies in, unless they are more than a hundredth of a shard.

The sample decides how the work is spread, not the result: that follows from the order
and the sizes alone. The driver sees the sample (``PER_RANGE`` keys a range, and as many
ranges as the session has shuffle partitions, 64 at least), a row per range, and a few
per shard.

Defined results: a null text has size 1 and the checksum of no bytes; a null id sorts
after every other; rows that repeat id and text are ordered as stored; with fewer
records than shards some shards are empty; an empty table gives an empty result.
Columns of any name pass through ``sharded`` and ``write_shards`` unchanged.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from featloom.llm.common import fresh, located, named_back, place, quoted, stored
from featloom.sources.local import small_table

# Sampled keys per range, as expected; and the parts that one range is cut into at once.
PER_RANGE = 24
# A range is overfull from this multiple of the mean size on.
OVERFULL = 2.0
# Equal texts stay together up to this share of a shard.
TOGETHER = 0.01
_KEY = ("hash", "order", "row")


def text_size(text: Column) -> Column:
    """Bytes of the text in UTF-8, and one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _keys(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """The stored key rows. ``row`` numbers them for good once they are written."""
    text, doc = F.col(quoted(text_col)), F.col(quoted(id_col))
    number = doc.try_cast("long")
    keys = docs.select(
        doc.alias("id"),
        text_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("hash"),
        F.coalesce(number, F.when(doc.isNull(), F.lit((1 << 63) - 1)).otherwise(F.xxhash64(doc))).alias("order"),
        F.monotonically_increasing_id().alias("row"),
        *([place().alias("place")] if carry else []),
    )
    return stored(keys, "shard-keys")


def _as_bytes(*columns: np.ndarray) -> np.ndarray:
    """Signed 64-bit columns as byte strings that sort like them."""
    wide = np.empty((len(columns[0]), len(columns)), ">u8")
    for i, c in enumerate(columns):
        wide[:, i] = np.asarray(c, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return wide.view(f"S{8 * len(columns)}").reshape(-1)


def _ranged(keys: DataFrame, cuts: np.ndarray) -> DataFrame:
    """``keys`` with ``part``: how many of the cuts, sorted keys, are not above a row's."""
    held = keys.sparkSession.sparkContext.broadcast(cuts)

    @F.arrow_udf("int")
    def part(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        rows = _as_bytes(*(x.to_numpy(zero_copy_only=False) for x in (a, b, c)))
        return pa.array(np.searchsorted(held.value, rows, side="right").astype(np.int32))

    return keys.withColumn("part", part(*_KEY))


def _sampled(rows: DataFrame, chance: Column) -> np.ndarray:
    """Keys, each as often as its chance says: the whole part of it, and once more with
    the chance that is left. A hash of the key decides, so reruns draw the same."""
    draw = F.pmod(F.xxhash64(*_KEY, F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    times = F.floor(chance + draw).alias("times")
    found = rows.select(*_KEY, times).where("times > 0").toArrow()
    keys = _as_bytes(*(found.column(k).to_numpy() for k in _KEY))
    return np.sort(np.repeat(keys, found.column("times").to_numpy()))


def _quantiles(sample: np.ndarray, parts: int) -> np.ndarray:
    places = np.arange(1, parts) * len(sample) // parts
    return np.unique(sample[places]) if len(sample) else sample


def _split(keys: DataFrame, ranges: int) -> tuple[DataFrame, list[Row]]:
    """``keys`` with ``part``, and per part its bytes and rows, in order."""
    total, count = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not count:
        return keys.withColumn("part", F.lit(0)), []
    wanted = ranges * PER_RANGE
    cuts = _quantiles(_sampled(keys, F.col("size") * (wanted / total)), ranges)
    while True:
        ranged = _ranged(keys, cuts)
        sizes = (
            ranged.groupBy("part")
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.max(F.struct(*_KEY)).alias("last"))
            .orderBy("part")
            .collect()
        )
        overfull = [r for r in sizes if r["rows"] > 1 and r["bytes"] > OVERFULL * total / ranges]
        if not overfull:
            return ranged, sizes
        # A sample within each, and its last key, which makes sure that it is divided.
        held = small_table(keys.sparkSession, {"of": "int", "held": "long"}, [(r["part"], r["bytes"]) for r in overfull])
        inside = ranged.join(F.broadcast(held), F.col("part") == F.col("of"))
        parts = F.ceil(F.col("held") * (ranges / total))
        sample = _sampled(inside, F.col("size") * parts * PER_RANGE / F.col("held"))
        number = np.searchsorted(cuts, sample, side="right")
        more = [
            _quantiles(sample[number == r["part"]], math.ceil(r["bytes"] * ranges / total)) for r in overfull
        ]
        lasts = _as_bytes(*np.array([tuple(r["last"]) for r in overfull], np.int64).T)
        cuts = np.unique(np.concatenate([cuts, lasts, *more]))


def _placed(keys: DataFrame, ranges: int) -> DataFrame:
    """Each key row with its number and the bytes before it in the whole order."""
    ranged, sizes = _split(keys, ranges)
    before = zip(accumulate((r["bytes"] for r in sizes), initial=0), accumulate((r["rows"] for r in sizes), initial=0))
    starts = [(r["part"], b, n) for r, (b, n) in zip(sizes, before)]
    offsets = small_table(keys.sparkSession, {"of": "int", "bytes_before": "long", "rows_before": "long"}, starts)
    order = Window.partitionBy("part").orderBy(*_KEY)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.join(F.broadcast(offsets), F.col("part") == F.col("of"))
        .withColumn("number", F.row_number().over(order) - 1 + F.col("rows_before"))
        .withColumn("before", F.sum("size").over(upto) - F.col("size") + F.col("bytes_before"))
        .drop("part", "of", "bytes_before", "rows_before")
    )


def plan(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranges: int | None = None,
    carry: bool = False,
) -> DataFrame:
    """A row per record: id, size, crc (of the text), shard, slot (its place in the
    shard, without gaps); with ``carry`` also place, the file and row it stands in."""
    spark = docs.sparkSession
    ranges = ranges or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = _keys(located(docs) if carry else docs, id_col, text_col, carry)
    rows = stored(_placed(keys, ranges), "shard-places")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]

    # By the middle of the record: floor(shards * (before + size / 2) / total).
    # 20 digits hold any long; ``decimal`` by itself has 10 only.
    before = "cast(before AS decimal(20))"
    own = F.expr(f"int(least({shards - 1}, {shards} * (2 * {before} + size) div {2 * max(total, 1)}))")
    rows = rows.withColumn("own", own)
    ends = rows.groupBy("own").agg(
        F.min("number").alias("first"), F.min("hash").alias("low"), F.max("hash").alias("high")
    ).orderBy("own").collect()
    firsts = {r["own"]: r["first"] for r in ends}
    parted = {b["low"] for a, b in zip(ends, ends[1:]) if a["high"] == b["low"]}
    moved = {}
    if parted:
        groups = rows.where(F.col("hash").isin(parted)).groupBy("hash").agg(
            F.sum("size").alias("bytes"), F.min("before").alias("before"),
            F.min("number").alias("first"), F.count("*").alias("rows"),
        )
        for g in groups.collect():
            if g["bytes"] * shards <= TOGETHER * total:
                s = min(shards - 1, shards * (2 * g["before"] + g["bytes"]) // (2 * total))
                moved[g["hash"]] = s
                # A shard that began within the group begins with it or after it.
                for t, n in firsts.items():
                    if g["first"] < n < g["first"] + g["rows"]:
                        firsts[t] = g["first"] if t <= s else g["first"] + g["rows"]
    shard = F.col("own")
    for h, s in moved.items():
        shard = F.when(F.col("hash") == h, F.lit(int(s))).otherwise(shard)
    start = F.array(*[F.lit(firsts.get(s, 0)).cast("long") for s in range(shards)])
    return rows.withColumn("shard", shard.cast("int")).select(
        "id", "size", "crc", "shard",
        (F.col("number") - F.get(start, F.col("shard"))).alias("slot"),
        *(["place"] if carry else []),
    )


def sharded(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, under other names if it has such columns."""
    shard, slot = fresh(docs, "shard", "slot")
    docs = located(docs)
    found = plan(docs, shards, id_col, text_col, carry=True)
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("record"), place().alias("at"))
    joined = rows.join(found.select("place", "shard", "slot"), F.col("at") == F.col("place"))
    return named_back(joined.select("record.*", F.col("shard").alias(shard), F.col("slot").alias(slot)))


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> None:
    """A folder per shard below ``path`` (shard=0 and so on), its files in order of
    ``slot``. Tasks write ranges of one shard each, so a shard may be of any size."""
    shard, slot = fresh(docs, "shard", "slot")
    rows = sharded(docs, shards, id_col, text_col)
    (
        rows.repartitionByRange(shard, slot)
        .sortWithinPartitions(shard, slot)
        .write.partitionBy(shard)
        .parquet(path)
    )
