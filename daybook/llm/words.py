"""Vectorised word scanning over Arrow string columns.

A word is a maximal run of characters outside ``\\x20\\x09-\\x0D``; A-Z count
as a-z where ``lower`` is set.  UTF-8 keeps every ASCII byte to itself, so
words can be cut from the raw bytes of the column without building Python
strings.  Each word gets a 64-bit hash: the difference of two prefix sums of a
polynomial in an odd base, taken back to position 0 by the base's inverse, and
finished with a bijective mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C13
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text handled at once; keeps the working arrays inside the CPU caches.
BLOCK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_LOWER_VALUE = _BYTE_VALUE.copy()
_LOWER_VALUE[65:91] = _BYTE_VALUE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GRAM = _rng.integers(1, 1 << 63, 64, dtype=np.int64).astype(U64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


class _Powers:
    up = np.ones(1, U64)
    down = np.ones(1, U64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                have = getattr(cls, name)
                setattr(cls, name, np.concatenate([have, have * U64(pow(base, len(have), 1 << 64))]))
        return cls.up, cls.down


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    _, offsets, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(data: np.ndarray, offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of rows of about ``size`` bytes: (first row, last row, bytes, offsets)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


@dataclass
class Hasher:
    """Prefix sums from which any byte range of one block can be hashed."""

    data: np.ndarray
    lower: bool = False

    def __post_init__(self) -> None:
        n = len(self.data)
        up, self.down = _Powers.upto(n + 1)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum((_LOWER_VALUE if self.lower else _BYTE_VALUE)[self.data] * up[:n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw ^ ((end - start).astype(U64) * U64(0xD6E8FEB86659FD93)))


@dataclass
class Words:
    """Words of a block of texts, in order: byte ranges, text index, hashes; ``first[i]:first[i+1]`` are text i's."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def scan_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, hasher: Hasher | None = None) -> Words:
    n, size = len(offsets) - 1, len(data)
    solid = np.zeros(size + 2, bool)
    np.logical_not(_SPACE[data], out=solid[1:-1])
    edge = solid[1:] != solid[:-1]
    starts, ends = edge & solid[1:], edge & solid[:-1]  # at byte i: a word starts; a word ended just before
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < size)]
    inside = cut[solid[cut] & solid[cut + 1]]  # a word would run over the border of two texts
    starts[inside] = True
    ends[inside] = True
    start, end = np.flatnonzero(starts), np.flatnonzero(ends)
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(n), np.diff(first))
    return Words(start, end, text, first, (hasher or Hasher(data, lower)).ranges(start, end))


def gram_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of k words inside one text."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    total = words.hash[:n] * _GRAM[0]
    for i in range(1, k):
        total = total + words.hash[i : n + i] * _GRAM[i]
    at = np.flatnonzero(words.text[:n] == words.text[k - 1 :])
    return mix(total[at]), at


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of a short sequence of words as a whole (it can't equal that of a longer run by construction of the length term)."""
    total = U64(len(hashes)) * U64(0xA24BAED4963EE407)
    for i, h in enumerate(hashes):
        total = total + h * _GRAM[i]
    return mix(np.array([total], U64))[0]


def shingle_sets(col: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct k-word shingles of each text; a text of 1 to k-1 words is one shingle, an empty one none."""
    with np.errstate(over="ignore"):
        data, offsets = string_buffers(col)
        for i, j, raw, off in blocks(data, offsets):
            words = scan_words(raw, off)
            grams, at = gram_hashes(words, k)
            cut = np.searchsorted(at, words.first)
            for t in range(j - i):
                a, b = words.first[t], words.first[t + 1]
                if b - a >= k:
                    x = np.sort(grams[cut[t] : cut[t + 1]])
                    yield x[np.concatenate([[True], x[1:] != x[:-1]])]
                elif b > a:
                    yield np.array([sequence_hash(words.hash[a:b])], U64)
                else:
                    yield np.zeros(0, U64)
