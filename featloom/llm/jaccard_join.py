"""Exact Jaccard join of documents on word shingles, by T-occurrence search.

A document's set is its distinct runs of five words (A-Z lower-cased; fewer words:
the whole sequence), as 64-bit hashes. Two documents link when their sets' overlap
is at least ``share`` of their union; a set of n then shares at least
t(n) = ceil(share * n) of its members with any partner.

1. Equal sets are one: documents are grouped by a 128-bit digest of their set.
2. Which sets can have a partner at all: a set stays only if t(n) of its members
   occur in another set as well, counted by inverted lists of all members, of a
   quarter of the hashes at a time in a large corpus. (Lists of a part of the members
   took less room but let most sets stay once the corpus was of some GB.)
   Members that several sets of a batch share are counted there and sent on twice
   only, so a frequent shingle makes no long list. Most documents end here.
3. The sets that stay are put together if they share a member of their prefixes
   (the n - t(n) + 1 rarest members by exact counts), by stars and components. Members
   that no other set has come first and join nothing, so a set with over n - t(n) of
   them is out, and passages that unrelated sets share rarely reach a prefix.
4. Together in a task, they are searched: for each set as a query the lists of
   its members in the task are split in short and L long ones (DivideSkip); the
   short ones are merged, those that occur at least T - L times are looked up in
   the long ones by binary search, and who reaches the pair's required overlap is
   a link. A component of more than ``block`` members is searched block against
   block, blocks being of sets of similar size and met by those whose sizes can link.
   A task gives back a forest and numbers of links, never pairs.
5. Forests of blocks are joined by components again.

Steps 2 to 4 lose no link, whatever the frequencies; frequency only changes the
order in which members are looked at. What a step stored is removed when no later one
reads it, and shuffle files with the step that wrote them. Work grows with the square of the number of
different, mutually similar texts of one component (blocks of them), not of copies.

Defined results: a null, empty or all-blank text has the empty set and no link;
repeated rows are documents like others; a null id is larger than any other and
names a component only if all its ids are null; an empty table gives an empty
result. Columns other than id and text are not read by ``classes``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from featloom.llm.common import SHORT_SHUFFLES, SMALL_BATCHES, let_go, located, named_back, place, quoted, settings, stored
from featloom.llm.components import components
from featloom.llm.words import in_chunks, mix, words_of

_FACTORS = [np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
)]


@dataclass(frozen=True)
class JoinSpec:
    percent: int = 80
    block: int = 500_000
    list_entries: int = 2_000_000
    # Entries up to which the lists are made in one pass instead of ``_PASSES``.
    pass_entries: int = 20_000_000
    # From so many sets on a member's rank follows their number, below that its hash only.
    frequent: int = 2

    def least(self, n):
        """Fewest members that a set of n shares with a partner."""
        return -(-n * self.percent // 100)

    def links(self, overlap, a, b):
        return 100 * overlap >= self.percent * (a + b - overlap)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted hashes of each text's set."""
    w = words_of(texts, lower=True)
    hashes = w.hashes()
    counts = np.bincount(w.text, minlength=len(texts))
    ends = np.cumsum(counts)
    out = []
    runs = max(len(hashes) - 4, 0)
    five = np.zeros(runs, np.uint64)
    for k, factor in enumerate(_FACTORS):
        five += hashes[k : runs + k] * factor
    five = mix(five)
    for end, n in zip(ends, counts):
        if n >= 5:
            out.append(np.unique(five[end - n : end - 4]))
        elif n:
            few = np.uint64(n) + (hashes[end - n : end] * np.array(_FACTORS[:n])).sum(dtype=np.uint64)
            out.append(mix(np.array([few], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _sets_of(texts: pa.Array) -> Iterator[np.ndarray]:
    data = ((t.as_py() or "").encode() for t in texts)
    for group in in_chunks(data):
        yield from shingle_sets(group)


def digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _six(x: np.ndarray) -> bytes:
    """The low six bytes of each number."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8")


PROBES = 1 << 19
# Entries of inverted lists that are sorted together.
_SORTED = 1 << 18
_LOW = np.uint64((1 << 48) - 1)


# Equal ranges of hashes whose lists are made one after the other.
_PASSES = 4
_LISTED = [f"listed{k}" for k in range(_PASSES)]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ranges = np.arange(1, _PASSES, dtype=np.uint64) * np.uint64((1 << 48) // _PASSES)
    for batch in batches:
        sizes, names, listed = [], [], [[] for _ in _LISTED]
        for s in _sets_of(batch.column("text")):
            sizes.append(len(s))
            names.append(digest(s) if len(s) else None)
            # Order and identity in lists are those of the high bits.
            tokens = s >> np.uint64(16)
            for column, some in zip(listed, np.split(tokens, np.searchsorted(tokens, ranges))):
                column.append(_six(some))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("place"), pa.array(sizes, pa.int64()),
             pa.array(names, pa.binary()), *(pa.array(x, pa.binary()) for x in listed)],
            ["id", "place", "n", "name", *_LISTED],
        )


def _binary(data: bytes, bounds: np.ndarray) -> pa.Array:
    """``data`` cut at ``bounds``, the first being 0 and the last its end."""
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
    )


def _owner(names: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(names), np.uint64)[::2] & _LOW


def _list_out(buckets: int):
    """Inverted lists of a batch, cut in buckets; members that several of the
    batch's sets have are counted here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = dict(zip(batch.column("name").to_pylist(), batch.column("listed").to_pylist()))
            if not sets:
                continue
            owners = _owner(list(sets))
            token = _from_six(b"".join(sets.values()))
            owner = np.repeat(owners, [len(v) // 6 for v in sets.values()])
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            first = np.ones(len(token), bool)
            first[1:] = token[1:] != token[:-1]
            group = np.cumsum(first) - 1
            many = np.bincount(group)
            shared = many[group] > 1
            credit, n = np.unique(owner[shared], return_counts=True)
            # The first two of a shared member go on, as counted.
            rank = np.arange(len(token)) - np.flatnonzero(first)[group]
            send = rank < 2
            known = shared[send]
            token, owner = token[send], owner[send]
            bucket = (token >> np.uint64(16)).astype(np.int64) * buckets >> 32
            # A row per bucket met, never more than members; one buffer holds all their bytes.
            begins = np.flatnonzero(np.diff(bucket, prepend=-1))
            bounds = np.append(begins, len(bucket))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[begins].astype(np.int32)), _binary(_six(token), bounds * 6),
                 _binary(_six(owner), bounds * 6), _binary(known.tobytes(), bounds),
                 _binary(b"", np.zeros(len(bounds), np.int64))],
                schema=_LISTS,
            )
            if len(credit):
                # Counts go along with any bucket.
                row = dict(bucket=int(credit[0]) % buckets, token=b"", owner=_six(credit), known=b"",
                           count=n.astype(np.int32).tobytes())
                yield pa.RecordBatch.from_pylist([row], schema=_LISTS)

    return run


_LISTS = pa.schema([("bucket", pa.int32()), ("token", pa.binary()), ("owner", pa.binary()),
                    ("known", pa.binary()), ("count", pa.binary())])
_CREDITS = pa.schema([("owner", pa.int64()), ("n", pa.int64())])


def _credits(owner: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.Table.from_arrays([pa.array(owner.astype(np.int64)), pa.array(n.astype(np.int64))], schema=_CREDITS)


def _joined(column: pa.ChunkedArray) -> bytes:
    return b"".join(value.as_buffer() for chunk in column.chunks for value in chunk)


def _count_shared(table: pa.Table) -> pa.Table:
    """Per bucket: how many of each set's members other sets have as well. Members are
    sorted and counted in parts, so that little is held besides the lists."""
    done = pc.greater(pc.binary_length(table.column("count")), 0)
    ready = table.filter(done)
    local = [
        _credits(_from_six(o), np.frombuffer(c, np.int32))
        for o, c in zip(ready.column("owner").to_pylist(), ready.column("count").to_pylist())
    ]
    table = table.filter(pc.invert(done))
    token, owner = (_from_six(_joined(table.column(c))) for c in ("token", "owner"))
    known = np.frombuffer(_joined(table.column("known")), bool)
    del table, ready
    parts = len(token) // _SORTED + 1
    found = []
    for k in range(parts):
        mine = np.flatnonzero(token % np.uint64(parts) == k) if parts > 1 else slice(None)
        found.append(_shared(token[mine], owner[mine], known[mine]))
    who, n = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(who)
    who, n = who[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])[: len(who)])
    return pa.concat_tables([_credits(who[first], np.add.reduceat(n, first) if len(first) else n), *local])


def _shared(token: np.ndarray, owner: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners of members that several have, and how many such members each has."""
    if not len(token):
        return owner, np.zeros(0, np.int64)
    order = np.lexsort((owner, token))
    token, owner, known = token[order], owner[order], known[order]
    first = np.ones(len(token), bool)
    first[1:] = token[1:] != token[:-1]
    group = np.cumsum(first) - 1
    # Copies of a set in other batches come as the same owner.
    new_owner = first.copy()
    new_owner[1:] |= owner[1:] != owner[:-1]
    owners = np.bincount(group, weights=new_owner)
    # A set that one batch has counted must not be counted again for a copy.
    runs = np.flatnonzero(new_owner)
    counted = np.logical_or.reduceat(known, runs)[np.cumsum(new_owner) - 1]
    return np.unique(owner[(owners[group] > 1) & new_owner & ~counted], return_counts=True)


def _search_task(spec: JoinSpec):
    """Links among the sets of a task; between two blocks only, if there are two."""

    def run(table: pa.Table) -> pa.Table:
        names = table.column("name").to_pylist()
        weight = table.column("copies").to_numpy()
        block = table.column("block").to_numpy()
        column = table.column("members").combine_chunks()
        sets = [m.values.to_numpy(zero_copy_only=False) for m in column]
        sizes = np.array([len(s) for s in sets])
        order = sorted(range(len(sets)), key=lambda i: (sizes[i], names[i]))
        names, sets = [names[i] for i in order], [sets[i] for i in order]
        sizes, weight, block = sizes[order], weight[order], block[order]
        across = bool(table.column("across")[0].as_py())
        parent, links = search(sets, sizes, block if across else None, weight, spec)
        return pa.Table.from_arrays(
            [pa.array(names, pa.binary()), pa.array([names[p] for p in parent], pa.binary()), pa.array(links)],
            schema=_FOREST,
        )

    return run


_FOREST = pa.schema([("name", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])


def search(
    sets: list[np.ndarray], sizes: np.ndarray, block: np.ndarray | None, weight: np.ndarray, spec: JoinSpec
) -> tuple[list[int], np.ndarray]:
    """A root for each set, and the weight of the sets it links with.

    ``sets`` are in order of size; each is a query against those before it.
    """
    m = len(sets)
    parent = list(range(m))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = np.zeros(m, np.int64)
    everything = np.concatenate(sets) if m else np.empty(0, np.uint64)
    _, token, many = np.unique(everything, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), sizes)
    # Lists: owners in order, member by member; one number stands for both.
    order = np.argsort(token * m + owner, kind="stable")
    listed = owner[order]
    keys = token[order] * m + listed
    begins = np.cumsum(many) - many
    ends_of_sets = np.cumsum(sizes)
    for q in range(m):
        own = token[ends_of_sets[q] - sizes[q] : ends_of_sets[q]]
        own = own[many[own] > 1]
        t = int(spec.least(int(sizes[q])))
        if len(own) < t:
            continue
        own = own[np.argsort(many[own], kind="stable")]
        longest = int(many[own[-1]])
        long_ones = min(t - 1, int(t / (0.01 * np.log2(longest + 1) + 1)))
        short, long = own[: len(own) - long_ones], own[len(own) - long_ones :]
        # The merge: owners of all short lists, counted.
        lengths = many[short]
        total = int(lengths.sum())
        gather = np.repeat(begins[short] - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)
        merged = listed[gather]
        merged = merged[merged < q]
        found, count = np.unique(merged, return_counts=True)
        enough = (count >= t - long_ones) & (sizes[found] >= t)
        if block is not None:
            enough &= block[found] != block[q]
        found, count = found[enough], count[enough]
        if not len(found):
            continue
        # Long lists: binary search for each candidate.
        step = max(1, PROBES // max(len(long), 1))
        for at in range(0, len(found), step):
            some = found[at : at + step]
            want = (long * m)[:, None] + some[None, :]
            spot = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            count[at : at + step] += (keys[spot] == want).sum(axis=0)
        found = found[spec.links(count, sizes[q], sizes[found])]
        if len(found):
            links[q] += weight[found].sum()
            links[found] += weight[q]
            top = root(q)
            for other in {root(int(f)) for f in found}:
                if other != top:
                    parent[max(other, top)] = min(other, top)
                    top = min(other, top)
    return [root(i) for i in range(m)], links


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s.astype(np.int64) for s in _sets_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("name"), batch.column("copies"), _lists(sets)], ["name", "copies", "members"]
        )


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def _prefixes(found: DataFrame, spec: JoinSpec) -> DataFrame:
    """name and prefix: the members by which a set meets others, the rarest, as many as
    a partner must share one of. A member stands as a number that orders like how many
    sets have it, then its hash; those that one set has are counted, not listed."""
    each = found.select(F.xxhash64("name").alias("set"), F.explode("members").alias("member"))
    many = each.withColumn("sets", F.count("*").over(Window.partitionBy("member"))).where("sets > 1")
    often = F.when(F.col("sets") >= spec.frequent, F.least("sets", F.lit(_MOST_SETS))).otherwise(F.lit(0))
    rank = F.shiftleft(often.cast("bigint"), 48).bitwiseOR(F.shiftrightunsigned("member", 16))
    shared = many.groupBy("set").agg(F.collect_list(rank).alias("ranks"))
    least = F.ceil(F.size("members") * spec.percent / 100)
    sizes = found.select("name", F.xxhash64("name").alias("of"), least.cast("int").alias("least"))
    places = F.size("ranks") - F.col("least") + 1
    return (
        sizes.join(shared, F.col("of") == F.col("set"))
        .where(places > 0)
        .select("name", F.slice(F.array_sort("ranks"), F.lit(1), places).alias("prefix"))
    )


# A larger number of sets does not change a member's rank.
_MOST_SETS = (1 << 15) - 1


@dataclass(frozen=True)
class Classes:
    """documents: id, place, n, name (of the set; null if empty).
    sets: name, label, links for every set that links with another."""

    documents: DataFrame
    sets: DataFrame


def _shared_members(sets: DataFrame, buckets: int) -> DataFrame:
    """owner (the low bytes of a name) and shared: how many of a set's listed members
    others have as well, 0 left out. ``sets``: name, listed."""
    lists = sets.mapInArrow(
        _list_out(buckets), "bucket int, token binary, owner binary, known binary, count binary"
    )
    counted = lists.groupBy("bucket").applyInArrow(_count_shared, "owner bigint, n bigint")
    return counted.groupBy("owner").agg(F.sum("n").alias("shared"))


def search_links(docs: DataFrame, spec: JoinSpec = JoinSpec(), id_col: str = "doc_id", text_col: str = "text") -> Classes:
    docs = located(docs)
    with settings(docs.sparkSession, SMALL_BATCHES | SHORT_SHUFFLES):
        return _search_links(docs, spec, id_col, text_col)


def _search_links(docs: DataFrame, spec: JoinSpec, id_col: str, text_col: str) -> Classes:
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)[id_col]
    at = "struct<file: string, row: bigint>"
    rows = docs.select(F.col(id_col).alias("id"), place().alias("place"), F.col(text_col).alias("text"))
    described = stored(
        rows.mapInArrow(
            _describe, f"id {id_type}, place {at}, n bigint, name binary, " + ", ".join(f"{c} binary" for c in _LISTED)
        ),
        "join-sets",
    )
    documents = stored(described.select("id", "place", "n", "name"), "join-documents")
    filled = described.where("name IS NOT NULL")
    entries = filled.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    passes = [_LISTED] if entries <= spec.pass_entries else [[c] for c in _LISTED]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")) * len(passes), int(entries // spec.list_entries) + 1)
    counted = [
        stored(_shared_members(filled.select("name", F.concat(*some).alias("listed")), buckets), "join-credits")
        for some in passes
    ]
    credits = reduce(DataFrame.unionByName, counted).groupBy("owner").agg(F.sum("shared").alias("shared"))
    sets = filled.groupBy("name").agg(
        F.first("n").alias("n"), F.count("*").alias("copies"), F.min("place").alias("at")
    )
    fewest = F.ceil(F.col("n") * spec.percent / 100)
    stays = (
        sets.withColumn("key", _owner_column("name"))
        .join(credits, F.col("key") == F.col("owner"))
        .where(F.col("shared") >= fewest)
        .select("name", "copies", "at")
    )
    # A merge join at every size: those that stay are a share of all documents.
    stay = stored(stays, "join-stay")
    for table in (described, *counted):
        let_go(table)
    texts = rows.select("place", "text").join(stay.hint("merge"), F.col("place") == F.col("at"))
    found = stored(
        texts.select("name", "copies", "text").mapInArrow(
            _full_sets, "name binary, copies bigint, members array<bigint>"
        ),
        "join-found",
    )
    let_go(stay)
    prefixes = stored(_prefixes(found, spec), "join-prefixes")
    met = prefixes.select("name", F.explode("prefix").alias("token"))
    stars = met.groupBy("token").agg(F.min("name").alias("least"), F.count("*").alias("n")).where("n > 1").withColumnRenamed("token", "of")
    edges = met.join(stars, F.col("token") == F.col("of")).select(F.col("name").alias("a"), F.col("least").alias("b"))
    groups = components(edges.distinct())
    let_go(prefixes)
    return Classes(documents, _search_groups(found, groups, spec))


def _owner_column(name: str):
    """The low six bytes of a name, as a number: as ``_owner`` has them."""
    six = F.substring(F.hex(name), 1, 12)
    turned = F.concat(*(F.substring(six, 2 * i + 1, 2) for i in range(5, -1, -1)))
    return F.conv(turned, 16, 10).cast("bigint")


def _search_groups(found: DataFrame, groups: DataFrame, spec: JoinSpec) -> DataFrame:
    member = groups.unionByName(
        groups.select(F.col("label").alias("vertex"), "label").distinct()
    )
    sizes = found.select("name", F.size("members").alias("n"))
    member = member.join(sizes, F.col("vertex") == F.col("name")).drop("name")
    sizes = member.groupBy(F.col("label").alias("of")).agg(F.sum("n").alias("size"))
    member = stored(
        member.join(sizes, F.col("label") == F.col("of")).select("vertex", "label", "size", "n"), "join-members"
    )
    let_go(groups)
    total = member.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tasks = total // spec.block + 1
    placed = found.join(member, F.col("name") == F.col("vertex")).select("name", "copies", "members", "label", "size", "n")
    small = placed.where(F.col("size") <= spec.block).select(
        F.concat(F.lit("s"), F.pmod(F.xxhash64("label"), F.lit(tasks))).alias("task"),
        "name", "copies", "members", F.lit(0).cast("bigint").alias("block"), F.lit(False).alias("across"),
    )
    # Large components by classes of size: sets that link are in the same or
    # neighbouring classes, as the classes' ratio is above that of linked sizes.
    ratio = 1.01 * 100 / spec.percent
    kind = F.floor(F.log(F.col("n")) / math.log(ratio))
    large = F.col("size") > spec.block
    parts = (
        member.where(large)
        .groupBy("label", kind.alias("class"))
        .agg(F.ceil(F.sum("n") / spec.block).alias("parts"))
    )

    def of_class(offset: int, name: str) -> DataFrame:
        return parts.select(F.col("label").alias(f"l{name}"), (F.col("class") - offset).alias(f"c{name}"), F.col("parts").alias(name))

    here = placed.where(large).withColumn("class", kind)
    for offset, name in ((0, "same"), (1, "above"), (-1, "below")):
        other = of_class(offset, name)
        here = here.join(other, (F.col("label") == F.col(f"l{name}")) & (F.col("class") == F.col(f"c{name}")), "left")
    mine = F.col("part")

    def meet(count: str, low, high) -> Column:
        """A task for each part of another class: its two blocks, in order."""
        each = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(count), F.lit(0)) - 1)
        some = F.when(F.coalesce(F.col(count), F.lit(0)) > 0, each).otherwise(F.array().cast("array<bigint>"))
        return F.transform(some, lambda p: F.struct(low(p).alias("low"), high(p).alias("high")))

    def number(offset: int, part: Column) -> Column:
        return (F.col("class") + offset) * 1_000_000 + part

    own = number(0, mine)
    pairs = F.concat(
        meet("same", lambda p: F.least(own, number(0, p)), lambda p: F.greatest(own, number(0, p))),
        meet("above", lambda p: own, lambda p: number(1, p)),
        meet("below", lambda p: number(-1, p), lambda p: own),
    )
    several = (
        here.withColumn("part", F.pmod(F.xxhash64("name", F.lit(1)), F.col("same")))
        .select("name", "copies", "members", "label", own.alias("block"), F.explode(pairs).alias("pair"))
        .select(
            F.concat_ws("-", F.hex("label"), F.col("pair.low").cast("string"), F.col("pair.high").cast("string")).alias("task"),
            "name", "copies", "members", "block", (F.col("pair.low") != F.col("pair.high")).alias("across"),
        )
    )
    forest = stored(
        small.unionByName(several).groupBy("task").applyInArrow(_search_task(spec), "name binary, root binary, links bigint"),
        "join-forest",
    )
    let_go(found)
    let_go(member)
    labels = components(forest.select(F.col("name").alias("a"), F.col("root").alias("b")))
    links = forest.groupBy("name").agg(F.sum("links").alias("links")).where("links > 0")
    return links.join(labels.withColumnRenamed("vertex", "of"), F.col("name") == F.col("of"), "left").select(
        "name", F.coalesce("label", "name").alias("label"), "links"
    )


def classes(docs: DataFrame, spec: JoinSpec = JoinSpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, place, n (set size), component_id (the smallest id
    of those linked, directly or not), first (whether it is the one to stay: of
    its component the smallest by id and place), links (documents linked with)."""
    found = search_links(docs, spec, id_col, text_col)
    copies = found.documents.where("name IS NOT NULL").groupBy(F.col("name").alias("of")).agg(F.count("*").alias("copies"))
    named = (
        found.documents.join(found.sets.withColumnRenamed("name", "in"), F.col("name") == F.col("in"), "left")
        .select("id", "place", "n", "name", F.coalesce("label", "name").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    least = named.where("label IS NOT NULL").groupBy(F.col("label").alias("in")).agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "place")).alias("least")
    )
    return (
        named.join(least, F.col("label") == F.col("in"), "left")
        .join(copies, F.col("name") == F.col("of"), "left")
        .select(
            "id", "place", "n",
            F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("least.id")).alias("component_id"),
            (F.col("label").isNull() | (F.col("place") == F.col("least.place"))).alias("first"),
            (F.col("links") + F.coalesce("copies", F.lit(1)) - 1).alias("links"),
        )
    )


def firsts(docs: DataFrame, spec: JoinSpec = JoinSpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, all its columns."""
    docs = located(docs)
    columns = [quoted(c) for c in docs.columns]
    stays = classes(docs, spec, id_col, text_col).where("first").select(F.col("place").alias("at"))
    rows = docs.select(place().alias("in"), F.struct(*columns).alias("row"))
    return named_back(rows.join(stays, F.col("in") == F.col("at")).select("row.*"))
