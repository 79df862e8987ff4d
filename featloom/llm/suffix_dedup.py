"""Removal of repeated passages: every byte that lies in a string of ``length`` bytes
which starts anywhere else too, judged on the input. By external induced sorting of
the suffixes concerned, to the depth of ``length`` bytes.

1. Sampled suffixes. Of the half-length strings in each window of ``length`` bytes
   the one of least hash is an anchor, a choice that depends on the window's bytes
   only: equal windows have equal anchors at equal offsets. About one byte in fifty
   is an anchor. An anchor whose string occurs once ends here (counted with partial
   sums before the shuffle, and joined, so a frequent string makes no large group).
2. Suffix tuples (anchor's name, bytes after it, bytes before it, place) of the others
   are dealt out by name and sorted by what follows the anchor: Spark's sort spills
   sorted runs to disk and merges them by a priority queue, whatever the shard's size.
   Tuples that repeat within a batch are settled at once and sent on once only.
3. Induction. A task reads the tuples in suffix order, with the length of the prefix
   each has in common with the one before. Going left byte by byte, a stable sort by
   the byte before gives the order of the suffixes that begin one byte earlier, and
   their common prefixes are one more than the least between them before. A suffix
   that shares ``length`` bytes with a neighbour starts a repeated string.
4. Intervals go back to their documents, are united and cut out, by Spark's own
   expressions: whole texts do not pass through Python again.

An anchor that more than ``class_rows`` suffixes share is settled window by window
by counting hashes of 128 bits instead, as a group in one task must be bounded.

Defined results: a null text counts as empty; texts shorter than ``length`` have
nothing removed; repeated rows are documents of their own (each wholly removed if long
enough); matches never cross documents. Bytes that are left are not decoded, as a
cut may go through a character. The result has the id and ``found`` only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from featloom.llm.common import SMALL_BATCHES, located, place, settings, stored
from featloom.llm.words import _powers, in_chunks, mix

# Bytes hashed together, each of which takes some 100 bytes meanwhile.
CHUNK = 1 << 18
GROUP = 4 << 20
# Rows sent on together.
SENT = 20_000
# Tuples compared with the one before together.
COMPARED = 1 << 14


@dataclass(frozen=True)
class PassageSpec:
    length: int = 200
    class_rows: int = 200_000
    task_rows: int = 20_000

    @property
    def half(self) -> int:
        return self.length // 2


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def _anchors(buffer: np.ndarray, limits: np.ndarray, spec: PassageSpec) -> tuple[np.ndarray, np.ndarray]:
    """Places and names of the anchors of texts that lie end to end in ``buffer``;
    ``limits``: where each ends."""
    n, half = len(buffer), spec.half
    if n < spec.length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = _powers.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    names = mix((sums[half:] - sums[:-half]) * down[: n - half + 1]) | np.uint64(1)
    width = spec.length - half + 1
    least = _sliding(names, width, np.minimum)
    # A window across the end of a text is none.
    begins = np.arange(len(least))
    least[limits[np.searchsorted(limits, begins, side="right")] < begins + spec.length] = 0
    edge = np.zeros(width - 1, np.uint64)
    chosen = _sliding(np.concatenate([edge, least, edge]), width, np.maximum) == names
    at = np.flatnonzero(chosen)
    return at, names[at]


def anchors(texts: list[bytes], spec: PassageSpec) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and names of each text's anchors. Long texts in overlapping parts."""
    out = []
    for group in in_chunks(texts, CHUNK):
        if len(group) == 1:
            text, found = group[0], {}
            for a in range(0, max(len(text) - spec.length + 1, 1), CHUNK):
                part = np.frombuffer(text[a : a + CHUNK + spec.length - 1], np.uint8)
                at, names = _anchors(part, np.array([len(part)]), spec)
                found.update(zip((at + a).tolist(), names.tolist()))
            at = np.array(sorted(found), np.int64)
            out.append((at, np.array([found[i] for i in at.tolist()], np.uint64)))
            continue
        sizes = np.fromiter(map(len, group), np.int64, len(group))
        limits = np.cumsum(sizes)
        at, names = _anchors(np.frombuffer(b"".join(group), np.uint8), limits, spec)
        cuts = np.searchsorted(at, np.concatenate([[0], limits]))
        for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
            out.append((at[i:j] - (limits[k] - sizes[k]), names[i:j]))
    return out


def _texts(column: pa.Array) -> list[bytes]:
    return [(t.as_py() or "").encode() for t in column]


def _name_anchors(spec: PassageSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [names.astype(np.int64) for _, names in anchors(_texts(batch.column("text")), spec)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in names])]).astype(np.int32)
            flat = np.concatenate(names) if names else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                ["k1", "k2", "names"],
            )

    return run


# A row is a suffix tuple, or, without bytes, an interval that is settled.
_TUPLES = pa.schema([("name", pa.int64()), ("sure", pa.int64()), ("right", pa.binary()), ("left", pa.binary()),
                     ("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int64()), ("upto", pa.int64())])
TUPLES = "name bigint, sure bigint, right binary, left binary, k1 bigint, k2 bigint, at bigint, upto bigint"
_SPANS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
SPANS = "k1 bigint, k2 bigint, start bigint, stop bigint"


def _tuples(spec: PassageSpec, large: bool):
    """Suffix tuples of the anchors named; ``large``: of those of large classes."""
    half, length = spec.half, spec.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("text", "k1", "k2", "large" if large else "names")]
            group, held = [], 0
            for text, *rest in zip(*columns):
                group.append(((text.as_py() or "").encode(), *(x.as_py() for x in rest)))
                held += len(group[-1][0])
                # Repeats are looked for within a few megabytes, for bounded memory.
                if held >= GROUP:
                    yield from tuples_of(group)
                    group, held = [], 0
            yield from tuples_of(group)

    def tuples_of(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[bytes, int], list] = {}
        found = anchors([g[0] for g in group], spec)
        for (text, k1, k2, want), (at, names) in zip(group, found):
            names = names.astype(np.int64)
            hit = np.isin(names, np.array(want or [], np.int64))
            for p, name in zip(at[hit].tolist(), names[hit].tolist()):
                low = max(p - half, 0)
                seen.setdefault((text[low : p + length], p - low), [name]).append((k1, k2, p))
        rows = []
        for (context, before), (name, *places) in seen.items():
            # Where the windows with this anchor begin and end.
            nearest = max(0, length - (len(context) - before))
            if len(places) > 1:
                for k1, k2, p in places:
                    rows.append((k1, None, None, None, k1, k2, p - before, p - nearest + length))
            sure = int.from_bytes(hashlib.blake2b(context[before : before + half], digest_size=7).digest())
            rows.append((name, sure, context[before + half :], context[:before][::-1], *places[0], None))
            if len(rows) >= SENT:
                yield _batch(rows, _TUPLES)
                rows = []
        if rows:
            yield _batch(rows, _TUPLES)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _range_minima(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least of x[i..j] for each pair i <= j."""
    table, span = [x], 1
    widest = int((j - i).max()) + 1 if len(i) else 1
    while span * 2 <= widest:
        table.append(np.minimum(table[-1][:-span], table[-1][span:]))
        span *= 2
    level = np.frexp((j - i + 1).astype(np.float64))[1] - 1
    out = np.empty(len(i), x.dtype)
    for k, row in enumerate(table):
        of = level == k
        out[of] = np.minimum(row[i[of]], row[j[of] - (1 << k) + 1])
    return out


def induce(
    classes: np.ndarray, right: list[pa.Array], left: list[pa.Array], spec: PassageSpec
) -> tuple[np.ndarray, np.ndarray]:
    """For tuples in order of (class, right): the nearest and farthest begin, in bytes
    before the anchor, of a repeated string; (1, 0) if there is none."""
    n, depth = len(classes), spec.length - spec.half
    after, n_right = _matrix(right, depth)
    before, n_left = _matrix(left, spec.half)
    nearest, farthest = np.full(n, spec.length, np.int32), np.full(n, -1, np.int32)
    order = np.arange(n)
    # Bytes in common after the anchor with the tuple before; -1: another class.
    common = np.full(n, -1, np.int32)
    for i in range(1, n, COMPARED):
        j = min(i + COMPARED, n)
        equal = np.minimum(
            np.argmin(np.pad(after[i:j] == after[i - 1 : j - 1], ((0, 0), (0, 1))), axis=1),
            np.minimum(n_right[i:j], n_right[i - 1 : j - 1]),
        )
        common[i:j] = np.where(classes[i:j] == classes[i - 1 : j - 1], equal, -1)
    del after
    offset = 0
    while len(order):
        best = common.copy()
        best[:-1] = np.maximum(best[:-1], common[1:])
        hit = order[best >= depth]
        nearest[hit] = np.minimum(nearest[hit], offset)
        farthest[hit] = offset
        if offset == spec.half:
            break
        # Who has no neighbour left, or no byte before, begins no longer string.
        going = (best >= 0) & (n_left[order] > offset)
        kept = np.flatnonzero(going)
        byte = classes[order[kept]] * 256 + before[order[kept], offset]
        turned = np.argsort(byte, kind="stable")
        old, byte = kept[turned], byte[turned]
        new = np.full(len(old), -1, np.int32)
        same = np.flatnonzero(byte[1:] == byte[:-1]) + 1
        if len(same):
            new[same] = _range_minima(common, old[same - 1] + 1, old[same])
            # Within a class no value between two tuples is -1.
            new[same] += 1
        order, common = order[old], new
        offset += 1
    nearest[farthest < 0] = 1
    farthest[farthest < 0] = 0
    return nearest, farthest


def _matrix(columns: list[pa.Array], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings of at most ``width`` bytes, padded with zeros, and their lengths."""
    out = np.zeros((sum(map(len, columns)), width), np.uint8)
    lengths, at = np.zeros(len(out), np.int32), 0
    for column in columns:
        _, offsets, data = column.cast(pa.binary()).buffers()
        if not len(column) or data is None:
            at += len(column)
            continue
        offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
        sizes = lengths[at : at + len(column)] = np.diff(offsets)
        out[at : at + len(column)][np.arange(width) < sizes[:, None]] = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        at += len(column)
    return out, lengths


def _induce_shard(spec: PassageSpec):
    def settle(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        names, sure, k1, k2, at = (
            np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("name", "sure", "k1", "k2", "at")
        )
        change = np.ones(len(names), np.int64)
        change[1:] = (names[1:] != names[:-1]) | (sure[1:] != sure[:-1])
        sides = ([b.column(c) for b in held] for c in ("right", "left"))
        nearest, farthest = induce(np.cumsum(change), *sides, spec)
        hit = farthest >= nearest
        found = [k1[hit], k2[hit], at[hit] - farthest[hit], at[hit] - nearest[hit] + spec.length]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=_SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, last = 0, None
        for batch in batches:
            settled = batch.filter(batch.column("upto").is_valid())
            if settled.num_rows:
                yield pa.RecordBatch.from_arrays([settled.column(c) for c in ("k1", "k2", "at", "upto")], schema=_SPANS)
            batch = batch.filter(batch.column("upto").is_null())
            if not batch.num_rows:
                continue
            names, start = batch.column("name").to_numpy(), 0
            for cut in np.flatnonzero(np.concatenate([[names[0] != last], names[1:] != names[:-1]])).tolist():
                if n + cut - start >= spec.task_rows:
                    yield settle([*held, batch.slice(start, cut - start)])
                    held, n, start = [], 0, cut
            held.append(batch.slice(start))
            n, last = n + batch.num_rows - start, names[-1]
        if held:
            yield settle(held)

    return run


def _window_keys(spec: PassageSpec):
    """For large classes: a key per window, from all its bytes. Made by the task that
    makes the tuples, in the same Python worker."""
    tuples = _tuples(spec, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in tuples(batches):
            columns = [c.to_pylist() for c in batch.columns]
            for name, sure, right, left, k1, k2, at, upto in zip(*columns):
                if upto is not None:
                    rows.append((None, k1, k2, at, upto))
                else:
                    for o in range(max(0, spec.length - spec.half - len(right)), len(left) + 1):
                        # With the offset, so that equal keys are of equal bytes at equal places.
                        anchored = f"{name}/{sure}/{o:06d}/".encode()
                        data = anchored + left[:o][::-1] + right[: spec.length - spec.half - o]
                        rows.append((hashlib.blake2b(data, digest_size=16).digest(), k1, k2, at - o, at - o + spec.length))
                if len(rows) >= SENT:
                    yield _batch(rows, _WINDOWS)
                    rows = []
        if rows:
            yield _batch(rows, _WINDOWS)

    return run


_WINDOWS = pa.schema([("window", pa.binary()), *_SPANS])


def repeated_spans(docs: DataFrame, spec: PassageSpec, base: DataFrame) -> DataFrame:
    """Intervals (k1, k2, start, stop) of repeated bytes; they overlap."""
    named = stored(
        base.select("k1", "k2", "text").mapInArrow(_name_anchors(spec), "k1 bigint, k2 bigint, names array<bigint>"),
        "passage-anchors",
    ).select("k1", "k2", F.explode("names").alias("name"))
    repeated = named.groupBy(F.col("name").alias("of")).agg(F.count("*").alias("n")).where("n > 1")
    # Stored, so that the join deals out both sides anew and splits a frequent name.
    repeated = stored(repeated, "passage-names")
    big = F.col("n") > spec.class_rows
    marks = stored(
        named.join(repeated, F.col("name") == F.col("of"))
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.when(~big, F.col("name"))).alias("names"), F.collect_set(F.when(big, F.col("name"))).alias("large")),
        "passage-marks",
    ).withColumnsRenamed({"k1": "m1", "k2": "m2"})
    marked = base.join(marks, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2"))).select(*base.columns, "names", "large")
    tuples = marked.mapInArrow(_tuples(spec, False), TUPLES)
    spans = (
        tuples.repartition("name").sortWithinPartitions("name", "sure", "right").mapInArrow(_induce_shard(spec), SPANS)
    )
    if marks.where(F.size("large") > 0).isEmpty():
        return spans
    windows = stored(
        marked.where(F.size("large") > 0).mapInArrow(_window_keys(spec), "window binary, " + SPANS),
        "passage-windows",
    )
    twice = windows.where("window IS NOT NULL").groupBy(F.col("window").alias("of")).agg(F.count("*").alias("n")).where("n > 1")
    again = windows.join(twice, F.col("window") == F.col("of")).select("k1", "k2", "start", "stop")
    return spans.unionByName(again).unionByName(windows.where("window IS NULL").drop("window"))


def united(spans: DataFrame) -> DataFrame:
    """A row per document: its intervals as an array of those that neither overlap nor
    touch, by where they start."""
    ordered = Window.partitionBy("k1", "k2").orderBy("start", "stop")
    before = F.max("stop").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = (before.isNull() | (F.col("start") > before)).cast("int")
    return (
        spans.withColumn("begins", begins)
        .withColumn("run", F.sum("begins").over(ordered))
        .groupBy("k1", "k2", "run")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .groupBy(F.col("k1").alias("s1"), F.col("k2").alias("s2"))
        .agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    )


def cut(text: Column, spans: Column) -> Column:
    """A struct of what is left of a text (bytes) without ``spans`` that are united,
    n_bytes, n_removed and n_spans."""
    data, edge = text.cast("binary"), F.array(F.lit(0).cast("bigint"))
    spans = F.coalesce(spans, F.array().cast("array<struct<start: bigint, stop: bigint>>"))
    size = F.octet_length(text).cast("bigint")
    starts = F.concat(spans["start"], F.array(size))
    between = F.arrays_zip(F.concat(edge, spans["stop"]).alias("a"), starts.alias("b"))
    # Spark joins strings only, and the bytes need not be one.
    kept = F.transform(between, lambda x: F.hex(F.substring(data, (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int"))))
    return F.struct(
        F.when(F.size(spans) == 0, data).otherwise(F.unhex(F.array_join(kept, ""))).alias("kept"),
        size.alias("n_bytes"),
        F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, x: n + x["stop"] - x["start"]).alias("n_removed"),
        F.size(spans).cast("bigint").alias("n_spans"),
    )


def without_repeats(
    docs: DataFrame, spec: PassageSpec = PassageSpec(), id_col: str = "doc_id", text_col: str = "text", into: str = "found"
) -> DataFrame:
    """A row per document: id and a struct ``into`` of kept (bytes), n_bytes,
    n_removed and n_spans."""
    docs = located(docs)
    where = place()
    base = docs.select(
        F.xxhash64(F.lit(1), where).alias("k1"), F.xxhash64(F.lit(2), where).alias("k2"),
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    # For the steps that are stored; the rest runs as the caller's session is set, so that
    # both joins share one shuffle of the texts.
    with settings(docs.sparkSession, SMALL_BATCHES):
        spans = united(repeated_spans(docs, spec, base))
    return base.join(spans, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left").select(
        F.col("id").alias(id_col), cut(F.col("text"), F.col("spans")).alias(into)
    )
