"""Words of many texts at once, as numpy arrays.

Texts are joined to one buffer of bytes, with a line break between them; words are
runs of bytes other than space and \\t \\n \\v \\f \\r. A word's hash is a polynomial
in its bytes modulo 2**64, from running sums over the buffer, mixed with its length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as many as were ever needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_powers = _Powers()


@dataclass
class Words:
    buffer: np.ndarray  # bytes
    starts: np.ndarray  # of words in the buffer
    ends: np.ndarray
    text: np.ndarray  # number of the text each word is in
    text_starts: np.ndarray  # where the texts begin in the buffer

    def hashes(self) -> np.ndarray:
        n = len(self.buffer)
        up, down = _powers.upto(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.buffer.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        sizes = (self.ends - self.starts).astype(np.uint64)
        return mix(raw + sizes * np.uint64(0xD6E8FEB86659FD93))


def is_space(data: np.ndarray) -> np.ndarray:
    """Which of the bytes part words."""
    return _IS_SPACE[data]


def words_of(texts: list[bytes], lower: bool = False) -> Words:
    """The words of ``texts``; ``lower`` turns A-Z to a-z first."""
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        buffer = _LOWER[buffer]
    space = is_space(buffer)
    edges = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edges[::2], edges[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    text_starts = np.cumsum(sizes) - sizes
    owner = np.searchsorted(text_starts, starts, side="right") - 1
    return Words(buffer, starts, ends, owner, text_starts)


def in_chunks(texts: Iterable[bytes], size: int = CHUNK) -> Iterator[list[bytes]]:
    """Groups of whole texts of about ``size`` bytes together at most, or one text."""
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > size:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group
