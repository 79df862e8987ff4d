"""A minimal perfect hash of 64-bit keys, as numpy arrays.

Level by level the keys are hashed to twice as many bits as there are keys left; a bit
that one key alone hits is that key's, the others go on to the next level. A key's
number is the rank of its bit. Some 4 bits a key. A key that was not built in may get
any number, so whoever looks up compares with the key stored at that number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from featloom.llm.words import mix

_WORD = 64
_MOST_LEVELS = 200


def _places(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    seed = np.uint64((level * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    return (mix(keys.view(np.uint64) ^ seed) % np.uint64(bits)).astype(np.int64)


@dataclass
class PerfectHash:
    sizes: np.ndarray  # words of each level
    words: np.ndarray  # the levels' bits, one after the other
    ranks: np.ndarray  # bits set before each word

    @staticmethod
    def of(sizes: np.ndarray, words: np.ndarray) -> PerfectHash:
        held = np.bitwise_count(words).astype(np.int64)
        return PerfectHash(sizes, words, np.cumsum(held) - held)

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        """For distinct int64 keys."""
        sizes, words, left = [], [], np.asarray(keys, np.int64)
        while len(left):
            if len(sizes) == _MOST_LEVELS:
                raise ValueError("keys to be hashed are not distinct")
            size = max(1, -(-2 * len(left) // _WORD))
            at = _places(left, len(sizes), size * _WORD)
            alone = np.bincount(at, minlength=size * _WORD) == 1
            bits = np.packbits(alone, bitorder="little").view(np.uint64)
            sizes.append(size)
            words.append(bits)
            left = left[~alone[at]]
        return PerfectHash.of(np.array(sizes, np.int64), np.concatenate([*words, np.zeros(0, np.uint64)]))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; -1 for some that were not built in, any for others."""
        keys = np.asarray(keys, np.int64)
        found = np.full(len(keys), -1, np.int64)
        rest, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = _places(keys[rest], level, int(size) * _WORD)
            word, bit = start + at // _WORD, (at % _WORD).astype(np.uint64)
            held = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word[held]] & ((np.uint64(1) << bit[held]) - np.uint64(1))
            found[rest[held]] = self.ranks[word[held]] + np.bitwise_count(below)
            rest, start = rest[~held], start + int(size)
            if not len(rest):
                break
        return found


@dataclass
class Table:
    """Values of keys, by perfect hash; the keys themselves are kept for comparison."""

    hash: PerfectHash
    keys: np.ndarray
    values: tuple[np.ndarray, ...]

    @staticmethod
    def build(keys: np.ndarray, *values: np.ndarray) -> Table:
        hashed = PerfectHash.build(keys)
        order = np.empty(len(keys), np.int64)
        order[hashed.find(keys)] = np.arange(len(keys))
        return Table(hashed, keys[order], tuple(v[order] for v in values))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is; -1 if it is not in the table."""
        at = self.hash.find(keys)
        if not len(self.keys):
            return at
        return np.where((at >= 0) & (self.keys[at] == keys), at, -1)
