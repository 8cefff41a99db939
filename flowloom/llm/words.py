"""Hashes of the words of many texts at once, with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: What a word's length and each of its stretches of eight bytes is told apart by.
_LENGTH, _STRETCH = np.random.default_rng(20240101).integers(0, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bits of the first so many of eight bytes.
_FIRST = np.array([2 ** (8 * i) - 1 for i in range(9)], np.uint64)
#: Odd numbers for the places of a window.
_WEIGHTS = np.random.default_rng(20240103).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """hashes of all words, text after text; counts of words by text; byte starts and ends in data."""

    hashes: np.ndarray
    counts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: bytes

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @property
    def position(self) -> np.ndarray:
        return np.arange(len(self.hashes)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)


def words_of(texts: list[str], lower: bool = False) -> Words:
    """Words are runs of bytes other than ASCII white space; with lower, A-Z hash as a-z."""
    encoded = [t.encode() for t in texts]
    data = b"\n".join([*encoded, b""])
    space = _SPACE[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    size = ends - starts
    padded = (data.lower() if lower else data) + bytes(8)  # of bytes, lower() lowers A-Z alone
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    hashes = mix((eights[starts] & _FIRST[np.minimum(size, 8)]) + size.astype(np.uint64) * _LENGTH)
    long = np.flatnonzero(size > 8)
    if len(long):
        more = (size[long] - 1) // 8
        done = np.cumsum(more)
        stretch = np.arange(1, done[-1] + 1) - np.repeat(done - more, more)
        left = np.repeat(size[long], more) - 8 * stretch
        values = eights[np.repeat(starts[long], more) + 8 * stretch] & _FIRST[np.minimum(left, 8)]
        total = np.add.reduceat(mix(values + mix(stretch.astype(np.uint64) * _STRETCH)), done - more)
        hashes[long] = mix(hashes[long] + total)
    edges = np.cumsum([len(e) + 1 for e in encoded])
    counts = np.diff(np.searchsorted(starts, edges), prepend=0) if len(edges) else np.empty(0, np.int64)
    return Words(hashes, counts, starts, ends, data)


def windows(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash of every k hashes in a row (64 at most), over the whole array."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, np.uint64(seed))
    for j in range(k):
        total += hashes[j : j + n] * _WEIGHTS[j]
    return mix(total)
