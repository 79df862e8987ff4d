"""Tokens of two tokenizers aligned, and how many documents hold each linked pair.

Where a token of A and a token of B end at the same byte, both sequences are cut; what
lies between two cuts is a group, and every A token of a group is linked with every B
token of it. A pair of ids counts once per document that holds it linked.

1. First pass: each task aligns its documents and writes the pairs found, with the
   number of its documents that have them.
2. The distinct pairs are dealt to ``BUCKETS`` buckets, and a minimal perfect hash is
   built of each. Parts of the first pass's rows are added into dense vectors of counts
   indexed by it, and the vectors are summed in a tree. Keys are kept in hash order,
   so what is looked up is verified.
3. Second pass: documents are aligned again and their pairs looked up. The most
   frequent pairs, ``FREQUENT`` at most, go to all tasks as one table under a perfect
   hash; a pair that is not in it is joined with the rest by key.

Texts are aligned by units: white space of blanks and line breaks, then what follows
up to the next. Neither tokenizer has tokens across their borders, which is checked
(of B's vocabulary at the start, of every unit as it is aligned), so a unit that
occurs often is aligned once per task, and long texts need no more memory than short
ones. Units are encoded many at a time, as one text.

Defined results: a text that is null or empty, or that a tokenizer does not give back
byte by byte, has no tokens: numbers are 0 and the groups ''. Repeated rows, and rows
without id, each count as a document. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from featloom.llm.common import SMALL_BATCHES, quoted, settings, stored
from featloom.llm.perfect_hash import PerfectHash, Table
from featloom.llm.words import in_chunks

BUCKETS = 256
# Rows of the first pass that one dense vector takes up, and vectors added at a time.
ROWS_PER_VECTOR = 2_000_000
FAN_IN = 8
# Pairs that every task holds: 17 bytes each and some 4 bits of hash, 40 MB.
FREQUENT = 2_000_000
# Bytes of text encoded together, and units remembered, per task: so many, and so many
# bytes of what is known of them.
_TOGETHER = 1 << 16
_MOST_UNITS = 400_000
_MOST_BYTES = 128 << 20
_UNIT_BYTES = 250  # of each, besides its text, pairs and groups
_SHORT = 500
# Text whose pairs are counted together, and pairs after which a task's are written.
_COUNTED = 1 << 20
_HELD = 1_000_000
_UNIT = re.compile(r"[ \n]+[^ \n]*")
# Other white space (Unicode's White_Space), after which a unit does not end.
_OTHER_SPACE = "".join(
    map(chr, (9, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
_ENDS_IN_SPACE = re.compile(f"[{_OTHER_SPACE}][ \n]")
_BLANK = chr(0x2581)  # how B writes one


def _byte_level() -> dict[str, int]:
    """The characters that byte-level tokenizers write bytes as: printable ones of
    Latin-1 as they are, the other bytes from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, from the bytes of their files; the libraries' objects are made
    in each process that needs them."""

    def __init__(self, a_json: str, b_model: bytes, a_pattern: str | None = None):
        self.a_json, self.b_model, self.a_pattern = a_json, b_model, a_pattern

    @staticmethod
    def read(a_path: str, b_path: str, a_pattern: str | None = None) -> Tokenizers:
        """``a_pattern`` is the one that A's pre-tokenizer splits texts by. If it is given
        and A merges in the order of its ids, short units are encoded by their ranks,
        several times as fast as by the library that its file is made for."""
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return Tokenizers(a.read(), b.read(), a_pattern)

    def __getstate__(self):
        return {"a_json": self.a_json, "b_model": self.b_model, "a_pattern": self.a_pattern}

    @cached_property
    def a_ranks(self):
        """A by ranks, or None: its merges have to make token after token, from bytes."""
        made = json.loads(self.a_json)
        model, split = made["model"], made["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        plain &= split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
        if self.a_pattern is None or not plain or made["normalizer"]:
            return None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"].get(x + y) for x, y in pairs]
        if ids != list(range(256, 256 + len(ids))):
            return None
        from tiktoken import Encoding

        ranks = {b: i for i, b in enumerate(self.a_bytes[: 256 + len(ids)])}
        return Encoding("a", pat_str=self.a_pattern, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def a(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_str(self.a_json)
        found.encode_special_tokens = True
        return found

    @cached_property
    def b(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.b_model)

    @cached_property
    def a_bytes(self) -> list[bytes]:
        level = _byte_level()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        return [bytes(level[c] for c in names.get(i, "")) for i in range(max(names, default=-1) + 1)]

    @cached_property
    def b_bytes(self) -> list[bytes]:
        found = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                found.append(bytes([int(piece[3:-1], 16)]))
                continue
            if re.search(f"[^ \n{_BLANK}][ \n{_BLANK}]", piece):
                raise ValueError(f"token {i} of the second tokenizer goes on across white space")
            found.append(piece.replace(_BLANK, " ").encode())
        return found

    def encode_a(self, text: str, longest: int) -> list[int]:
        """``longest``: characters of the longest unit in the text. Merging by ranks
        takes the square of that."""
        if self.a_ranks is not None and longest <= _SHORT:
            return self.a_ranks.encode_ordinary(text)
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode_b(self, text: str) -> list[int]:
        """Of a text that begins with a blank, which the tokenizer adds itself."""
        return self.b.encode(text[1:])


def _distinct(values: np.ndarray) -> np.ndarray:
    """In order. Sorting is many times faster here than the hashing of np.unique."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])[: len(values)]]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... sizes[0] of them, then the same of the next."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


# Of some units: counts of each, pairs, how often each is linked, pairs of each unit,
# and written groups of each.
Aligned = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]


class _Rows:
    """An array that rows are added to, with room for more so that few adds copy it."""

    def __init__(self, *shape: int, dtype: type = np.int64):
        self.room, self.size = np.empty((0, *shape), dtype), 0

    def add(self, rows: np.ndarray) -> None:
        end = self.size + len(rows)
        if end > len(self.room):
            room = np.empty((end + end // 4, *self.room.shape[1:]), self.room.dtype)
            room[: self.size] = self.room[: self.size]
            self.room = room
        self.room[self.size : end] = rows
        self.size = end

    @property
    def rows(self) -> np.ndarray:
        return self.room[: self.size]


class Units:
    """What is known of units: counts, linked pairs and written groups of each. With a
    table, of the pairs only those that it lacks."""

    def __init__(self, tokenizers: Tokenizers, table: Table | None = None, written: bool = True):
        self.tokenizers, self.table, self.written = tokenizers, table, written
        self.a_size = np.array([len(b) for b in tokenizers.a_bytes], np.int64)
        self.b_size = np.array([len(b) for b in tokenizers.b_bytes], np.int64)
        width = len(str(max(len(self.a_size), len(self.b_size))))
        ids = [str(i).encode() for i in range(max(len(self.a_size), len(self.b_size)))]
        self.digits = np.array(ids, f"S{width}").view(np.uint8).reshape(len(ids), width)
        self.n_digits = np.array([len(i) for i in ids], np.int64)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.held = 0  # bytes, about
        self._counts = _Rows(4)
        self._pairs, self._times, self._starts = _Rows(), _Rows(), _Rows()
        self._starts.add(np.zeros(1, np.int64))
        self._scores = _Rows(2)

    @property
    def counts(self) -> np.ndarray:
        """Per unit: tokens of A, of B, groups, links; -1 if it is not given back."""
        return self._counts.rows

    @property
    def pairs(self) -> np.ndarray:
        """Of one unit after the other."""
        return self._pairs.rows

    @property
    def times(self) -> np.ndarray:
        """How often each pair is linked in its unit; kept with a table only."""
        return self._times.rows

    @property
    def starts(self) -> np.ndarray:
        return self._starts.rows

    @property
    def scores(self) -> np.ndarray:
        """Per unit, of pairs in the table: links with the best count, sum of counts."""
        return self._scores.rows

    def of(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Per text the numbers of its units, in order."""
        if len(self.number) > _MOST_UNITS or self.held > _MOST_BYTES:
            self.clear()
        cut = [_units(t) for t in texts]
        get = self.number.get
        found = [list(map(get, units)) for units in cut]
        new = dict.fromkeys(
            u for units, known in zip(cut, found) if None in known for u, k in zip(units, known) if k is None
        )
        if new:
            self._learn(list(new))
            found = [list(map(get, units)) if None in known else known for units, known in zip(cut, found)]
        return [np.array(known, np.int64) for known in found]

    def _learn(self, new: list[str]) -> None:
        for units, (counts, pairs, times, sizes, groups) in (x for some in _together(new) for x in self._parts(some)):
            for u in units:
                self.number[u] = len(self.number)
            self._counts.add(counts)
            self.groups += groups if self.written else []
            if self.table is not None:
                pairs, times, sizes = self._look_up(pairs, times, sizes)
                self._times.add(times)
            self._pairs.add(pairs)
            self._starts.add(self.starts[-1] + np.cumsum(sizes))
            self.held += _UNIT_BYTES * len(units) + sum(map(len, units)) + sum(map(len, groups)) + 16 * len(pairs)

    def _parts(self, units: list[str]) -> Iterator[tuple[list[str], Aligned]]:
        """The units aligned together or, if one of them hinders that, in halves."""
        found = self._aligned(units)
        if found is not None:
            yield units, found
        elif len(units) == 1:
            none = np.zeros(0, np.int64)
            yield units, (np.full((1, 4), -1), none, none, np.zeros(1, np.int64), [b""])
        else:
            for half in (units[: len(units) // 2], units[len(units) // 2 :]):
                yield from self._parts(half)

    def _look_up(self, pairs: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores the units; gives back the pairs that the table lacks."""
        at = self.table.places(pairs)
        docs, best = (v[at] if len(v) else np.zeros(len(at), np.int64) for v in self.table.values)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        known = np.where(at >= 0, times, 0)
        new = np.zeros((len(sizes), 2), np.int64)
        np.add.at(new, owner, np.column_stack([known * best, known * docs]))
        self._scores.add(new)
        missed = at < 0
        return pairs[missed], times[missed], np.bincount(owner[missed], minlength=len(sizes))

    def _aligned(self, units: list[str]) -> Aligned | None:
        """Of units, encoded as one text; None if a tokenizer does not give it back or
        has a token across their borders."""
        text = "".join(units)
        # What B is given begins with a blank, which is not all of it; the unit in
        # front is taken off again.
        front = "" if text[0] == " " != text else " a"
        data = (front + text).encode()
        a = np.array(self.tokenizers.encode_a(front + text, max(map(len, units))), np.int64)
        b = np.array(self.tokenizers.encode_b(front + text), np.int64)
        for ids, known in ((a, self.tokenizers.a_bytes), (b, self.tokenizers.b_bytes)):
            if b"".join([known[i] for i in ids.tolist()]) != data:
                return None
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cuts = a_end[b_end[np.minimum(np.searchsorted(b_end, a_end), len(b_end) - 1)] == a_end]
        unit_end = np.cumsum([len(u.encode()) for u in units]) + len(front)
        if front:
            unit_end = np.concatenate([[len(front)], unit_end])
        place = np.searchsorted(cuts, unit_end)
        if (cuts[np.minimum(place, len(cuts) - 1)] != unit_end).any():
            return None
        group_a, group_b = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        groups = np.diff(place, prepend=-1)
        unit = np.repeat(np.arange(len(unit_end)), groups)  # of each group
        add = lambda x: np.bincount(unit, x, len(unit_end)).astype(np.int64)
        counts = np.column_stack([add(in_a), add(in_b), groups, add(in_a * in_b)])
        pairs, times, sizes = self._linked(a, b, in_a, in_b, unit, len(unit_end))
        texts = self._written(a, b, in_a, in_b, unit, len(unit_end)) if self.written else [b""] * len(unit_end)
        if front:
            pairs, times = pairs[sizes[0] :], times[sizes[0] :]
            counts, sizes, texts = counts[1:], sizes[1:], texts[1:]
        return counts, pairs, times, sizes, texts

    def _linked(self, a, b, in_a, in_b, unit, n_units):
        """Distinct pairs of each unit, and how often each is linked in it. Of a group
        with many tokens the distinct ids are paired, so what is made is bounded by
        ids, not by the product of tokens."""
        a_start, b_start = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        small = in_a * in_b <= 64
        made = np.where(small, in_a * in_b, 0)
        group = np.repeat(np.arange(len(in_a)), made)
        within = _ranges(np.zeros(len(made), np.int64), made)
        keys = [(a[a_start[group] + within // in_b[group]] << 16) | b[b_start[group] + within % in_b[group]]]
        owner, times = [unit[group]], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(~small):
            x, nx = np.unique(a[a_start[g] : a_start[g] + in_a[g]], return_counts=True)
            y, ny = np.unique(b[b_start[g] : b_start[g] + in_b[g]], return_counts=True)
            keys.append(((x << 16)[:, None] | y[None, :]).reshape(-1))
            times.append((nx[:, None] * ny[None, :]).reshape(-1))
            owner.append(np.full(len(x) * len(y), unit[g]))
        keys, times, owner = map(np.concatenate, (keys, times, owner))
        order = np.lexsort((keys, owner))
        keys, times, owner = keys[order], times[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(keys) != 0) | (np.diff(owner) != 0)])[: len(keys)])
        summed = np.add.reduceat(times, first) if len(first) else times
        return keys[first], summed, np.bincount(owner[first], minlength=n_units)

    def _written(self, a, b, in_a, in_b, unit, n_units) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each unit, without a semicolon at the end."""
        size = in_a + in_b
        start = np.cumsum(size) - size
        ids = np.empty(len(a) + len(b), np.int64)
        after = np.full(len(ids), ord(","), np.uint8)
        ids[_ranges(start, in_a)] = a
        ids[_ranges(start + in_a, in_b)] = b
        after[start + in_a - 1] = ord("|")
        after[start + size - 1] = ord(";")
        n = self.n_digits[ids]
        ends = np.cumsum(n + 1)
        out = np.empty(ends[-1], np.uint8)
        for d in range(self.digits.shape[1]):
            has = n > d
            out[ends[has] - 1 - n[has] + d] = self.digits[ids[has], d]
        out[ends - 1] = after
        last = ends[np.cumsum(size) - 1]  # of each group
        stops = last[np.cumsum(np.bincount(unit, minlength=n_units)) - 1]
        data = out.tobytes()
        return [data[i : j - 1] for i, j in zip([0, *stops[:-1].tolist()], stops.tolist())]


def _units(text: str) -> list[str]:
    """Of a blank and the text."""
    if not text:
        return []
    spaced = " " + text
    found = _UNIT.findall(spaced)
    if _ENDS_IN_SPACE.search(spaced):
        whole = [found[0]]
        for u in found[1:]:
            if whole[-1][-1] in _OTHER_SPACE:
                whole[-1] += u
            else:
                whole.append(u)
        found = whole
    return found


def _together(units: list[str]) -> Iterator[list[str]]:
    """Groups to be encoded as one text. White space at a unit's end, which texts may
    end with, would run on into the next unit."""
    group, held = [], 0
    for u in units:
        if u[-1].isspace():
            yield [u]
            continue
        group.append(u)
        held += len(u)
        if held > _TOGETHER:
            yield group
            group, held = [], 0
    if group:
        yield group


class _Counted:
    """Pairs and numbers of documents, added up until they are many."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, docs: np.ndarray) -> None:
        self.parts.append((keys, docs))
        # What is new is merged when it is half of what was merged before, so that few
        # pairs take little memory and many are not merged often.
        if sum(len(k) for k, _ in self.parts[1:]) > max(_HELD // 4, len(self.parts[0][0]) // 2):
            self.merge()

    def merge(self) -> None:
        keys, docs = (np.concatenate(x) for x in zip(*self.parts))
        self.parts.clear()
        order = np.argsort(keys)
        keys, docs = keys[order], docs[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        self.parts.append((keys[first], np.add.reduceat(docs, first) if len(first) else docs))


def _pairs_of_docs(units: Units, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, and the documents among ``texts`` that hold each."""
    cut = units.of([t.decode() for t in texts])
    lost = units.counts[:, 0] < 0
    cut = [u for u in cut if not lost[u].any()]
    span = len(units.number)
    seen = _distinct(np.concatenate([np.zeros(0, np.int64), *[u + i * span for i, u in enumerate(cut)]]))
    doc, unit = np.divmod(seen, max(span, 1))
    sizes = np.diff(units.starts)[unit]
    held = units.pairs[_ranges(units.starts[unit], sizes)]
    held |= np.repeat(doc << 32, sizes)
    once = _distinct(held)
    return np.unique(once & 0xFFFFFFFF, return_counts=True)


def pair_rows(docs: DataFrame, tokenizers: Tokenizers, text_col: str = "text") -> DataFrame:
    """The first pass: (pair, docs, part) with at most one row per pair and ``part``.
    A pair is the id of A times 65536 and that of B."""
    held = docs.sparkSession.sparkContext.broadcast(tokenizers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, counted, part = Units(held.value, written=False), _Counted(), TaskContext.get().partitionId()
        names = ["pair", "docs", "part"]

        def rows() -> Iterator[pa.RecordBatch]:
            if counted.parts:
                counted.merge()
                keys, docs = counted.parts.pop()
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(docs), pa.array(np.full(len(keys), part, np.int64))], names)

        for batch in batches:
            texts = (t.as_py() for t in batch.column(0))
            for chunk in in_chunks((t for t in texts if t), _COUNTED):
                counted.add(*_pairs_of_docs(units, chunk))
                if len(counted.parts) == 1 and len(counted.parts[0][0]) > _HELD:
                    yield from rows()
        yield from rows()

    text = F.col(quoted(text_col)).cast("binary")
    return docs.select(text.alias("text")).mapInArrow(run, "pair long, docs long, part long")


def _built(rows: pa.Table) -> pa.Table:
    """The perfect hash of a bucket's pairs, and the pairs in its order."""
    keys = rows.column("pair").to_numpy()
    table = Table.build(keys)
    return pa.table(
        {
            "bucket": rows.column("bucket")[:1],
            "sizes": [table.hash.sizes.tobytes()],
            "words": [table.hash.words.tobytes()],
            "keys": [table.keys.tobytes()],
        },
        _HASH_ROW,
    )


_HASH_ROW = pa.schema([("bucket", pa.int32()), ("sizes", pa.binary()), ("words", pa.binary()), ("keys", pa.binary())])
_VECTOR_ROW = pa.schema([("bucket", pa.int32()), ("slice", pa.int32()), ("counts", pa.binary())])


def _vector(bucket: int, part: int, counts: np.ndarray) -> pa.Table:
    return pa.table({"bucket": [bucket], "slice": [part], "counts": [counts.tobytes()]}, _VECTOR_ROW)


def _filled(rows: pa.Table, hashes: pa.Table) -> pa.Table:
    """The dense vector of one slice of a bucket."""
    made = hashes.to_pylist()[0]
    hashed = PerfectHash.of(*(np.frombuffer(made[c], t) for c, t in (("sizes", np.int64), ("words", np.uint64))))
    known = np.frombuffer(made["keys"], np.int64)
    keys, docs = rows.column("pair").to_numpy(), rows.column("docs").to_numpy()
    at = hashed.find(keys)
    if (known[at] != keys).any():
        raise ValueError("a pair is not in its hash")
    counts = np.zeros(len(known), np.int64)
    np.add.at(counts, at, docs)
    return _vector(made["bucket"], made["slice"], counts)


def _summed(rows: pa.Table) -> pa.Table:
    first, *rest = rows.to_pylist()
    counts = np.frombuffer(first["counts"], np.int64).copy()
    for r in rest:
        counts += np.frombuffer(r["counts"], np.int64)
    return _vector(first["bucket"], first["slice"] // FAN_IN, counts)


def pair_counts(docs: DataFrame, tokenizers: Tokenizers, text_col: str = "text") -> DataFrame:
    """A stored row per linked pair: pair, a, b, docs, and best: whether no other pair
    of its A id is in more documents."""
    with settings(docs.sparkSession, SMALL_BATCHES):
        rows = stored(pair_rows(docs, tokenizers, text_col), "pair-rows")
    bucket = F.pmod(F.xxhash64("pair"), F.lit(BUCKETS)).cast("int").alias("bucket")
    spark = docs.sparkSession
    slices = -(-rows.count() // (BUCKETS * ROWS_PER_VECTOR)) or 1

    distinct = rows.select("pair").distinct().select("pair", bucket)
    hashes = stored(distinct.groupBy("bucket").applyInArrow(_built, _ddl(_HASH_ROW)), "pair-hashes")
    parts = hashes.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    dealt = rows.select("pair", "docs", bucket, F.pmod(F.xxhash64("part"), F.lit(slices)).cast("int").alias("slice"))
    # A slice that has no rows of a bucket makes no vector.
    vectors = dealt.groupBy("bucket", "slice").cogroup(parts.groupBy("bucket", "slice"))
    vectors = vectors.applyInArrow(lambda x, y: _filled(x, y) if len(x) else _VECTOR_ROW.empty_table(), _ddl(_VECTOR_ROW))
    while slices > 1:
        node = F.expr(f"slice div {FAN_IN}").cast("int")
        vectors = vectors.groupBy("bucket", node.alias("node")).applyInArrow(_summed, _ddl(_VECTOR_ROW))
        slices = -(-slices // FAN_IN)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(*(batch.column(i).to_pylist() for i in range(2))):
                columns = [pa.array(np.frombuffer(x, np.int64)) for x in (keys, counts)]
                yield pa.RecordBatch.from_arrays(columns, ["pair", "docs"])

    whole = vectors.join(hashes.select("bucket", "keys"), "bucket").select("keys", "counts")
    counts = stored(whole.mapInArrow(spread, "pair long, docs long"), "pair-counts")
    a = F.shiftright("pair", 16).cast("int")
    # At most a row per id of A.
    most = counts.groupBy(a.alias("id")).agg(F.max("docs").alias("most"))
    found = counts.join(F.broadcast(most), a == F.col("id")).select(
        "pair", a.alias("a"), F.expr("cast(pair & 65535 as int)").alias("b"), "docs",
        (F.col("docs") == F.col("most")).alias("best"),
    )
    return stored(found, "pair-best")


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _frequent(counts: DataFrame, n: int) -> DataFrame:
    """The most frequent pairs, ``FREQUENT`` at most: those above a count."""
    if n <= FREQUENT:
        return counts
    floor = 0.0
    kept = n
    while kept > FREQUENT:
        above = counts.where(F.col("docs") > floor)
        share = max(0.5, 1 - 0.9 * FREQUENT / kept)
        higher = above.agg(F.percentile_approx("docs", share, 10_000)).first()[0]
        floor = max(higher, floor + 1)
        kept = counts.where(F.col("docs") > floor).count()
    return counts.where(F.col("docs") > floor)


def aligned(
    docs: DataFrame,
    tokenizers: Tokenizers,
    id_col: str = "doc_id",
    text_col: str = "text",
    counts: DataFrame | None = None,
    digest: bool = False,
) -> DataFrame:
    """A row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups (``a1,a2|b1;a3|b2``); with ``digest``, the groups' SHA-256 in their place.
    ``counts`` are those of ``pair_counts`` over all documents, made here if None."""
    spark = docs.sparkSession
    counts = pair_counts(docs, tokenizers, text_col) if counts is None else counts
    n = counts.count()
    top = _frequent(counts, n).select("pair", "docs", F.col("best").cast("long").alias("best")).toArrow()
    table = Table.build(*(top.column(c).to_numpy() for c in ("pair", "docs", "best")))
    held = spark.sparkContext.broadcast((tokenizers, table))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(*held.value)
        for batch in batches:
            start = 0
            for chunk in in_chunks((t.as_py() or b"" for t in batch.column(1)), _COUNTED):
                found = [_row(units, u, digest) for u in units.of([t.decode() for t in chunk])]
                values, groups, pairs, times = zip(*found)
                columns = [batch.column(0).slice(start, len(chunk)), *map(pa.array, np.array(values, np.int64).T)]
                columns += [pa.array(groups, pa.string()), pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names)
                start += len(chunk)

    names = ["id", *numbers, "groups", "pairs", "times"]
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = ", ".join([f"id {kind}", *[f"{c} long" for c in numbers], "groups string, pairs array<long>, times array<long>"])
    found = rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    with settings(spark, SMALL_BATCHES):
        found = stored(found, "aligned")
    if n > FREQUENT:
        found = _with_rest(found, counts)
    return found.select("id", *numbers, "groups")


def _row(units: Units, cut: np.ndarray, digest: bool) -> tuple:
    """Numbers, groups, and pairs that the table lacks, of one document."""
    if not len(cut) or (units.counts[cut, 0] < 0).any():
        return [0] * 6, "", [], []
    values = [*units.counts[cut].sum(axis=0).tolist(), *units.scores[cut].sum(axis=0).tolist()]
    groups = b";".join([units.groups[u] for u in cut.tolist()])
    text = hashlib.sha256(groups).hexdigest() if digest else groups.decode()
    if not len(units.pairs):
        return values, text, [], []
    each, often = np.unique(cut, return_counts=True)
    sizes = np.diff(units.starts)[each]
    at = _ranges(units.starts[each], sizes)
    times = units.times[at] * np.repeat(often, sizes)
    return values, text, units.pairs[at].tolist(), times.tolist()


def _with_rest(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds what the pairs that were not in the table count. They are the rarer ones."""
    missed = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("m"))
    links = missed.select("row", F.col("m.pairs").alias("pair"), F.col("m.times").alias("times"))
    more = (
        links.join(counts.select("pair", "docs", "best"), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("docs")).alias("more_sum"),
        )
    )
    none = F.lit(0).cast("long")
    return found.join(more, "row", "left").withColumns(
        {
            "n_best": F.col("n_best") + F.coalesce("more_best", none),
            "count_sum": F.col("count_sum") + F.coalesce("more_sum", none),
        }
    )
