"""Words, word hashes and shingles of whole Arrow batches, in numpy.

A word is a run of bytes other than the ASCII white space 0x20 and 0x09-0x0D. Hashes have 64
bits. Work goes in pieces of bounded size, so memory does not follow the length of a batch;
one document is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(count: int, stream: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit values; the same everywhere."""
    start = np.uint64((stream * 0x1000003 + 1) * GOLDEN % (1 << 64))
    return mix(start + np.arange(1, count + 1, dtype=np.uint64) * MULTIPLIER)


def byte_table(lower: bool) -> np.ndarray:
    table = seeds(256, 7)
    if lower:
        table[65:91] = table[97:123]
    return table


def is_space() -> np.ndarray:
    space = np.zeros(256, dtype=bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return space


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and where each row starts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + n + 1]
    data = (
        np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]]
        if data_buffer is not None
        else np.zeros(0, np.uint8)
    )
    return data, offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row stands alone."""
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield lo, hi
        lo = hi


class Words:
    """The words of some rows: byte bounds, and for each row the range of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = ~is_space()[data]
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        firsts = offsets[:-1]
        before[firsts[firsts < len(data)]] = False
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        lasts = offsets[1:] - 1
        after[lasts[lasts >= 0]] = False
        self.data, self.inside, self.offsets = data, inside, offsets
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.rows = np.searchsorted(self.starts, offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One value per word: a polynomial over its bytes, scrambled with its length."""
        table = byte_table(lower)
        out = np.empty(len(self.starts), np.uint64)
        ends = np.cumsum(self.ends - self.starts)
        lo = 0
        while lo < len(out):
            base = ends[lo - 1] if lo else 0
            hi = max(int(np.searchsorted(ends, base + PIECE_BYTES, side="right")), lo + 1)
            a, b = self.starts[lo], self.ends[hi - 1]
            chosen = self.data[a:b][self.inside[a:b]]
            lengths = self.ends[lo:hi] - self.starts[lo:hi]
            heads = np.cumsum(lengths) - lengths
            place = np.arange(len(chosen)) - np.repeat(heads, lengths)
            powers = np.cumprod(np.full(int(lengths.max()), MULTIPLIER, np.uint64))
            sums = np.add.reduceat(table[chosen] * powers[place], heads)
            out[lo:hi] = mix(sums + lengths.astype(np.uint64))
            lo = hi
        return out


def fold(hashes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """One value for each run of ``width`` words that starts at the given places."""
    value = np.full(len(starts), np.uint64(width), np.uint64)
    for step in range(width):
        value = mix(value * MULTIPLIER + hashes[starts + step])
    return value


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct shingles of its lower-cased words.

    A row with fewer words than ``width`` has its whole sequence as one shingle; a row
    without words (or null) has none.
    """
    data, offsets = flat(column)
    for lo, hi in pieces(offsets):
        words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        hashes = words.hashes(lower=True)
        places = np.arange(max(len(hashes) - width + 1, 0))
        rolled = fold(hashes, places, width)
        for first, last in zip(words.rows[:-1], words.rows[1:], strict=True):
            if last - first >= width:
                yield np.unique(rolled[first : last - width + 1])
            elif last > first:
                yield fold(hashes, np.array([first]), last - first)
            else:
                yield np.zeros(0, np.uint64)
