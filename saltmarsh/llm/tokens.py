"""Words and word hashes of many texts at once, on the UTF-8 bytes of an Arrow column.

The texts of a batch lie one after another in one byte buffer; every step is a NumPy pass over that buffer, so there is
no Python work per word. Batches are cut so that the passes stay within a few tens of MB whatever the texts' lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; one longer text is worked on alone.
SLICE_BYTES = 1 << 20

_B = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_B_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: list[np.ndarray] = []


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags: which bytes part words."""
    out = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


WHITESPACE = separators((0x20, 0x20), (0x09, 0x0D))
NOT_ALPHANUMERIC = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # for lower-cased text
NOT_LETTER = separators((0x00, 0x60), (0x7B, 0x7F))  # for lower-cased text
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i below n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES)
        _POWERS[:] = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_B, _B_INV)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of the texts of one slice. Word k lies at data[start[k]:end[k]]; text i has words first[i] to first[i+1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit polynomial hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = powers(len(self.data))
        value = _TABLE[self.data]
        value *= up
        # the bytes between two words must not count: sums up to each end less sums up to each start
        total = np.empty(len(value) + 1, np.uint64)
        total[0] = 0
        np.cumsum(value, out=total[1:])
        return mixed((total[self.end] - total[self.start]) * down[self.start])

    def text_of(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(start word, hash) of each run of n consecutive words of one text, in order."""
        total = len(hashes)
        if total < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        up, down = powers(total)
        sums = np.empty(total + 1, np.uint64)
        sums[0] = 0
        np.cumsum(hashes * up, out=sums[1:])
        left = np.repeat(self.first[1:], self.counts) - np.arange(total)  # words from here to the end of the text
        at = np.flatnonzero(left >= n)
        return at, mixed((sums[at + n] - sums[at]) * down[at])


def same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """For each k, whether word i[k] of ``a`` and word j[k] of ``b`` have the same bytes."""
    size = a.end[i] - a.start[i]
    same = size == b.end[j] - b.start[j]
    at = np.flatnonzero(same)
    size = size[at]
    if not len(at):
        return same
    starts = np.cumsum(size) - size
    inner = np.arange(int(size.sum())) - np.repeat(starts, size)
    equal = a.data[np.repeat(a.start[i[at]], size) + inner] == b.data[np.repeat(b.start[j[at]], size) + inner]
    same[at] = np.logical_and.reduceat(equal, starts)
    return same


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        offsets = np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray, lower: bool = False) -> Words:
    """Words: the longest runs of bytes that are no separators, within each text."""
    if lower:
        data = LOWER[data]
    word = np.zeros(len(data) + 1, dtype=bool)
    np.logical_not(separator[data], out=word[:-1])
    begins, ends = word.copy(), word.copy()
    begins[1:-1] &= ~word[:-2]
    ends[:-1] &= ~word[1:]
    ends = ends[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    begins[inner] = word[inner]
    last = offsets[1:] - 1
    last = last[last >= 0]
    ends[last] = word[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def slices(offsets: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``most`` bytes together, or one text."""
    most = most or SLICE_BYTES
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def sliced(column: pa.Array, separator: np.ndarray, lower: bool = False, most: int | None = None) -> Iterator[tuple[int, int, Words]]:
    """(first text, end text, words) for slices of a column."""
    data, offsets = buffers(column)
    for i, j in slices(offsets, most):
        yield i, j, split(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], separator, lower)


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
