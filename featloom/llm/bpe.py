"""Byte-level BPE: encoding and decoding with a rank file.

Texts are cut into pieces by the pattern; each distinct piece of a task is encoded
once. Pieces to encode are put in buckets of similar length, a padded matrix of
byte ids each. In every round each row merges its leftmost pair of least rank, all
rows at once: the ranks of all neighbouring pairs stand in a second matrix, of
which a merge changes two entries, found in a hash table of pairs; both matrices
are then closed up by a shift, and rows without a pair left go. A piece that is
itself in the vocabulary is that id.

A part of n bytes takes up to n rounds of n steps; ordinary pieces are words. A piece
above ``PIECE`` bytes is first cut between bytes that stand side by side in no token,
where no merge can cross: its parts are merged on their own, with the same ids. What
is still above ``PIECE`` (a run of one letter, say) is merged with a queue of its
pairs by rank and place, in the same order, in n log n steps.
What a task holds is bounded: pieces are looked up in groups of ``GROUP``,
however long the text, matrices have at most ``CELLS`` cells, and the memory of
pieces seen is emptied at ``SEEN`` of them.

Defined results: a null or empty text has no ids and decodes to an empty text; a
null list of ids decodes to null; an unknown id raises. Other columns are not
touched.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession, functions as F

GROUP = 200_000
CELLS = 1 << 20
PIECE = 1_000
SEEN = 250_000
LONG = 1 << 22
# Before a piece that is looked up as it is; other keys are words after one space.
WHOLE = "\0"
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> bytes:
    """The rank file's content; a line per token, in base64, and its rank."""
    with open(path, "rb") as f:
        return f.read()


class PairTable:
    """Ranks of pairs of ids by open addressing."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(len(pairs) * 2).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        slots, left = self._first(pairs), np.arange(len(pairs))
        while len(left):
            # Of those that want the same free slot one gets it.
            at = slots[left]
            free = left[self.keys[at] == -1]
            self.keys[slots[free]] = pairs[free]
            won = self.keys[slots[left]] == pairs[left]
            self.ranks[slots[left[won]]] = ranks[left[won]]
            left = left[~won]
            slots[left] = (slots[left] + 1) & self.mask

    def _first(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where there is none."""
        pairs = left.astype(np.int64) << 32 | right
        slots = self._first(pairs)
        out = np.full(len(pairs), NONE, np.int32)
        open_ = np.arange(len(pairs))
        while len(open_):
            at = slots[open_]
            keys = self.keys[at]
            hit = keys == pairs[open_]
            out[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit & (keys != -1)]
            slots[open_] = (slots[open_] + 1) & self.mask
        return out


def _uneven(words: list[str]) -> bool:
    """Whether there is white space next to a space or at an end of the text; such
    a text is cut by the pattern alone."""
    if "" in words:
        return True
    return any(map(str.isspace, {w[0] for w in words} | {w[-1] for w in words}))


class Coder:
    def __init__(self, ranks: bytes, pattern: str):
        rows = (line.split() for line in ranks.splitlines() if line)
        self.ids = {base64.b64decode(token): int(rank) for token, rank in rows}
        self.tokens = {i: t for t, i in self.ids.items()}
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        pairs, merged, get = [], [], self.ids.get
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    merged.append(rank)
        self.table = PairTable(np.array(pairs, np.int64), np.array(merged, np.int32))
        every = np.frombuffer(b"".join(self.ids), np.uint8)
        side_by_side = np.ones(max(len(every) - 1, 0), bool)
        ends = np.cumsum([len(token) for token in self.ids])[:-1]
        side_by_side[ends - 1] = False
        self.inside = np.zeros((256, 256), bool)
        self.inside[every[:-1][side_by_side], every[1:][side_by_side]] = True
        self.forget()

    def forget(self) -> None:
        """Drops what was remembered; an idle worker keeps the tables only."""
        self.pieces, self.words = _Memo(self._learn_pieces), _Memo(self._learn_words)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list = [None] * len(pieces)
        rest = []
        for i, piece in enumerate(pieces):
            known = self.ids.get(piece)
            if known is None and piece:
                rest.append(i)
            else:
                out[i] = np.array([] if known is None else [known], np.int32)
        parts = [self._parts(pieces[i]) for i in rest]
        found = iter(self._merge_parts([p for some in parts for p in some]))
        for i, some in zip(rest, parts):
            out[i] = np.concatenate([next(found) for _ in some])
        return out

    def _parts(self, piece: bytes) -> list[bytes]:
        """A long piece cut where no token goes across."""
        if len(piece) <= PIECE:
            return [piece]
        data = np.frombuffer(piece, np.uint8)
        cuts = np.flatnonzero(~self.inside[data[:-1], data[1:]]) + 1
        bounds = [0, *cuts.tolist(), len(piece)]
        return [piece[i:j] for i, j in zip(bounds, bounds[1:])]

    def _merge_parts(self, parts: list[bytes]) -> list[np.ndarray]:
        """Ids of each part by merges alone."""
        out: list = [None] * len(parts)
        rest = []
        for i, part in enumerate(parts):
            if len(part) > PIECE:
                out[i] = self._merge_queued(part)
            else:
                rest.append(i)
        rest.sort(key=lambda i: len(parts[i]))
        start = 0
        while start < len(rest):
            shortest = len(parts[rest[start]])
            end = start
            # A bucket: lengths within an eighth of the shortest, cells bounded.
            while (
                end < len(rest)
                and (n := len(parts[rest[end]])) <= shortest + max(shortest // 8, 1)
                and (end == start or (end - start + 1) * n <= CELLS)
            ):
                end += 1
            bucket = rest[start:end]
            for i, ids in zip(bucket, self._merge_bucket([parts[i] for i in bucket])):
                out[i] = ids
            start = end
        return out

    @cached_property
    def _pairs(self) -> dict[int, int]:
        used = self.table.keys >= 0
        return dict(zip(self.table.keys[used].tolist(), self.table.ranks[used].tolist()))

    def _merge_queued(self, part: bytes) -> np.ndarray:
        """The same merges, the next one found by a queue; ids are a linked list."""
        ids = self.byte_ids[np.frombuffer(part, np.uint8)]
        n = len(ids)
        ranks = self.table.find(ids[:-1], ids[1:])
        places = np.flatnonzero(ranks != NONE)
        queue = (ranks[places].astype(np.int64) << 32 | places).tolist()
        heapify(queue)
        ids, rank_of = array("q", ids.tolist()), self._pairs.get
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        gone = bytearray(n)

        def pair(at: int) -> int | None:
            return rank_of(ids[at] << 32 | ids[after[at]]) if after[at] < n else None

        while queue:
            entry = heappop(queue)
            rank, at = entry >> 32, entry & 0xFFFFFFFF
            # An entry is old if its id was merged away or is now part of another pair.
            if gone[at] or pair(at) != rank:
                continue
            merged = after[at]
            gone[merged] = 1
            ids[at], after[at] = rank, after[merged]
            if after[at] < n:
                before[after[at]] = at
            for changed in (before[at], at):
                if changed >= 0 and (new := pair(changed)) is not None:
                    heappush(queue, new << 32 | changed)
        keep = np.frombuffer(gone, np.uint8) == 0
        return np.array(ids, np.int32)[keep]

    def _merge_bucket(self, pieces: list[bytes]) -> list[np.ndarray]:
        sizes = np.array([len(p) for p in pieces])
        width = int(sizes.max())
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        filled = np.arange(width) < sizes[:, None]
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[filled] = self.byte_ids[flat]
        ranks = np.full((len(pieces), width), NONE, np.int32)
        paired = filled[:, 1:]
        ranks[:, :-1][paired] = self.table.find(ids[:, :-1][paired], ids[:, 1:][paired])
        rows, out = np.arange(len(pieces)), [None] * len(pieces)
        while len(rows):
            best = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), best]
            going = least != NONE
            if not going.all():
                for r in np.flatnonzero(~going):
                    out[rows[r]] = ids[r, : sizes[r]].copy()
                rows, ids, ranks, sizes = rows[going], ids[going], ranks[going], sizes[going]
                best, least = best[going], least[going]
                if not len(rows):
                    break
                width = int(sizes.max())
                ids, ranks = ids[:, :width], ranks[:, :width]
            each = np.arange(len(rows))
            ids[each, best] = least
            self._close_up(ids, best + 1, -1)
            self._close_up(ranks, best, NONE)
            sizes = sizes - 1
            # The pairs before and after the merged id are new.
            after = best + 1 < sizes
            r = each[after]
            ranks[r, best[after]] = self.table.find(ids[r, best[after]], ids[r, best[after] + 1])
            r = each[~after]
            ranks[r, best[~after]] = NONE
            before = best > 0
            r = each[before]
            ranks[r, best[before] - 1] = self.table.find(ids[r, best[before] - 1], ids[r, best[before]])
        return out

    @staticmethod
    def _close_up(cells: np.ndarray, at: np.ndarray, filler: int) -> None:
        """Takes one cell out of each row and moves what follows up."""
        if len(cells) == 1:
            row, i = cells[0], int(at[0])
            row[i:-1] = row[i + 1 :]
        else:
            later = np.arange(cells.shape[1] - 1) >= at[:, None]
            np.copyto(cells[:, :-1], cells[:, 1:].copy(), where=later)
        cells[:, -1] = filler

    def _learn_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.merge([p.encode() for p in pieces])
        return np.concatenate(found), np.array([len(f) for f in found], np.int64)

    def _learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = self.pattern.findall
        parts = [[w[1:]] if w[0] == WHOLE else cut(" " + w) for w in words]
        ids, sizes = self.pieces.look_up([p for part in parts for p in part])
        counts = np.array([len(part) for part in parts])
        return ids, np.add.reduceat(sizes, np.cumsum(counts) - counts)

    def _keys(self, text: str) -> Iterator[list[str]]:
        """What a text's ids are looked up by, in groups.

        No piece goes on past the last letter before a single space, so a text is
        cut at those first, and a word with its pieces is remembered as one.
        """
        if len(text) >= LONG:
            matches = (WHOLE + m.group() for m in self.pattern.finditer(text))
            yield from iter(lambda: list(islice(matches, GROUP)), [])
            return
        first, *words = text.split(" ")
        if WHOLE in text or _uneven([first, *words]):
            yield [WHOLE + piece for piece in self.pattern.findall(text)]
        else:
            yield [WHOLE + piece for piece in self.pattern.findall(first)] + words

    def encode(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many ids each text has."""
        counts: list[int] = []
        out: list[np.ndarray] = []
        keys: list[str] = []
        owners: list[int] = []
        numbers: list[int] = []

        def settle() -> None:
            if keys:
                ids, sizes = self.words.look_up(keys)
                out.append(ids)
                ends = np.cumsum(numbers)
                for i, n in zip(owners, np.add.reduceat(sizes, ends - numbers)):
                    counts[i] += int(n)
                keys.clear(), owners.clear(), numbers.clear()

        for i, text in enumerate(texts):
            counts.append(0)
            for group in self._keys(text) if text else ():
                keys.extend(group)
                owners.append(i)
                numbers.append(len(group))
                if len(keys) >= GROUP:
                    settle()
        settle()
        return (np.concatenate(out) if out else np.empty(0, np.int32)), np.array(counts, np.int64)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Memo:
    """Ids of the keys seen, learned when first asked for; emptied when full."""

    def __init__(self, learn):
        self.learn = learn
        self._forget()

    def _forget(self) -> None:
        self.seen = _Numbered()
        self.pool = np.empty(1 << 16, np.int32)
        self.starts, self.sizes, self.used = np.empty(0, np.int64), np.empty(0, np.int64), 0

    def look_up(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all keys in a row, and how many ids each has."""
        if len(self.seen) > SEEN:
            self._forget()
        known = len(self.seen)
        index = np.fromiter(map(self.seen.__getitem__, keys), np.int64, len(keys))
        if len(self.seen) > known:
            ids, sizes = self.learn(list(islice(self.seen, known, None)))
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
            self.pool[self.used : self.used + len(ids)] = ids
            self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.used += len(ids)
        sizes = self.sizes[index]
        ends = np.cumsum(sizes)
        gather = np.repeat(self.starts[index] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        return self.pool[gather], sizes


class _Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


@lru_cache(maxsize=2)
def coder(ranks: bytes, pattern: str) -> Coder:
    """One per worker process, kept between its tasks."""
    return Coder(ranks, pattern)


class Tokenizer:
    """Column functions for one vocabulary; its ranks (bounded by the vocabulary)
    are broadcast once."""

    def __init__(self, spark: SparkSession, ranks: bytes, pattern: str):
        shared = spark.sparkContext.broadcast(ranks)

        @F.arrow_udf("array<int>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = coder(shared.value, pattern)
            for texts in batches:
                ids, counts = own.encode(t.as_py() for t in texts)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
            own.forget()

        @F.arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = coder(shared.value, pattern)
            for rows in batches:
                # A row at a time, as ids take many times their space as objects.
                yield pa.array((own.decode(r.as_py()) if r.is_valid else None for r in rows), pa.binary())

        @F.arrow_udf("ids array<int>, decoded binary")
        def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = coder(shared.value, pattern)
            for texts in batches:
                ids, counts = own.encode(t.as_py() for t in texts)
                ends = np.cumsum(counts)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids, pa.int32())
                )
                texts = (own.decode(ids[e - n : e].tolist()) for e, n in zip(ends, counts))
                yield pa.StructArray.from_arrays([listed, pa.array(texts, pa.binary())], ["ids", "decoded"])
            own.forget()

        self._encode, self._decode, self._both = encode, decode, both

    def encode(self, text: Column) -> Column:
        """The text's token ids."""
        return self._encode(text)

    def round_trip(self, text: Column) -> Column:
        """The text's token ids and the bytes these decode to, by one Python worker."""
        return self._both(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that the ids stand for."""
        return self._decode(ids)
