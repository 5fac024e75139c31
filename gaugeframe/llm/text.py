"""Words and hashes of many texts at once, on the UTF-8 bytes of an Arrow column.

A batch is cut into slices of a few megabytes; one slice is one numpy array, so the
memory of a task does not grow with the batch.  A single longer text is a slice of
its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U64 = np.uint64

# The white space that separates words.
SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.random.default_rng(20_240_501).integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_BREAK, _NOTHING = pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string())
_FACTOR = 0x9E3779B97F4A7C15
_BASE = U64(_FACTOR)
_BASE_INVERSE = U64(pow(_FACTOR, -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Slice:
    """Some whole texts: their bytes, each followed by a line feed, and where they begin.

    ``bounds`` has one entry more than there are texts; text ``i`` is
    ``data[bounds[i]:bounds[i + 1] - 1]``.
    """

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a number per byte over each text."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def slices(column: pa.Array, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column in slices of about ``limit`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + limit, "right")))
        part = pc.binary_join_element_wise(texts.slice(first, last - first), _BREAK, _NOTHING)
        _, offsets, data = part.buffers()
        bounds = np.frombuffer(offsets, np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
        yield Slice(first, _LOWER[data] if lower else data, bounds - bounds[0])
        first = last


def ranges(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of every text (one entry more)."""
    inside = np.concatenate(([False], ~_SPACE[s.data]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    return starts, ends, np.searchsorted(starts, s.bounds)


class Rolling:
    """Polynomial prefix hash of a slice: the hash of any range of bytes in constant time."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.back = np.full(n + 1, _BASE_INVERSE, U64)
        self.back[0] = U64(1)
        np.multiply.accumulate(self.back, out=self.back)
        power = np.full(n, _BASE, U64)
        power[:1] = U64(1)
        np.multiply.accumulate(power, out=power)
        power *= _LETTER[data]
        self.prefix = np.zeros(n + 1, U64)
        np.add.accumulate(power, out=self.prefix[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        ranged = (self.prefix[ends] - self.prefix[starts]) * self.back[starts]
        return mix(ranged + (ends - starts).astype(U64))


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of every window of ``n`` words, text limits not regarded."""
    count = max(0, len(words) - n + 1)
    # Hashes of 1, 2, 4 and so on words, put together to those of ``n`` from the left.
    total, taken, part, size = np.zeros(count, U64), 0, words, 1
    left, parts = n, []
    while left:
        parts.append((part, size))
        left >>= 1
        if left:
            part, size = part[:-size] * U64(pow(_FACTOR, size, 2**64)) + part[size:], 2 * size
    for part, size in reversed(parts):
        if n & size:
            total = total * U64(pow(_FACTOR, size, 2**64)) + part[taken : taken + count]
            taken += size
    return mix(total)


def least_of(values: np.ndarray, n: int) -> np.ndarray:
    """The least of every ``n`` values in a row."""
    size, count = 1, max(0, len(values) - n + 1)
    while 2 * size <= n:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    return np.minimum(values[:count], values[n - size : n - size + count])


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """True for each word at which a window of ``n`` words of one text begins."""
    total = int(first[-1]) if len(first) else 0
    begins = np.zeros(total + 1, np.int64)
    sizes = np.maximum(np.diff(first) - n + 1, 0)
    np.add.at(begins, first[:-1], (sizes > 0).astype(np.int64))
    np.add.at(begins, first[:-1] + sizes, -(sizes > 0).astype(np.int64))
    return np.cumsum(begins[:total]) > 0


def text_of(first: np.ndarray) -> np.ndarray:
    """The text of every word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice: index of the first text, all sorted distinct shingle hashes, bounds and words per text.

    Texts are compared by lower-case words (A-Z only).  A text with fewer than ``n``
    words, but at least one, has its whole sequence as its single shingle.
    """
    for s in slices(column, lower=True):
        starts, ends, first = ranges(s)
        words = Rolling(s.data).of(starts, ends)
        begins = np.flatnonzero(window_starts(first, n))
        hashes, owner = windows(words, n)[begins] if len(words) >= n else np.zeros(0, U64), text_of(first)[begins]
        counts = np.diff(first)
        short = np.flatnonzero((counts > 0) & (counts < n))
        if len(short):
            extra = np.array(
                [windows(words[first[i] : first[i + 1]], int(counts[i]))[0] ^ U64(counts[i]) for i in short], U64
            )
            hashes, owner = np.concatenate((hashes, mix(extra))), np.concatenate((owner, short))
        order = np.argsort(hashes)
        # Numbers of 16 bits are sorted in linear time.
        order = order[np.argsort(owner[order].astype(np.uint16 if len(s) < 1 << 16 else np.int64), kind="stable")]
        hashes, owner = hashes[order], owner[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[fresh], owner[fresh]
        yield s.first, hashes, np.searchsorted(owner, np.arange(len(s) + 1)), counts
