"""Repetition inside a document by suffix array and longest-common-prefix intervals.

The suffixes of a text's words are sorted by prefix doubling, many texts at once; only suffixes
that are still tied go on to the next round.
Neighbours in the sorted order then give the longest common prefixes, read off the ranks of
each round. A suffix that shares at least ``least`` words with a neighbour starts a repeated
substring; the longest one per place is the maximal interval there. Their spans are united
(overlapping occurrences too) to the covered fraction of the words.

A text is kept when the covered fraction and the longest repeat, both against its own length,
stay within limits. Null and word-less texts have no words and no repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import words

#: Fewest words that count as a repeated substring.
LEAST_WORDS = 8
MOST_COVERED = 0.5
MOST_LONGEST = 0.3
SYMBOLS = b"#*$%&|<>"


def classes(leading: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by (leading, second): the order, where classes begin, and each one's new rank.

    A rank is the place in the whole order where its class begins, so members of other classes
    keep theirs.
    """
    order = np.lexsort((second, leading))
    lead, sec = leading[order], second[order]
    old = np.ones(len(order), dtype=bool)
    old[1:] = lead[1:] != lead[:-1]
    new = old.copy()
    new[1:] |= sec[1:] != sec[:-1]
    places = np.arange(len(order))
    first_old = np.maximum.accumulate(np.where(old, places, 0))
    first_new = np.maximum.accumulate(np.where(new, places, 0))
    return order, new, lead + first_new - first_old


def repeats(hashes: np.ndarray, rows: np.ndarray, least: int) -> np.ndarray:
    """For each word, the length of the longest repeated substring that starts there.

    ``rows`` bounds the texts; substrings stay within one text. Lengths below ``least`` are 0.
    """
    size = len(hashes)
    longest = np.zeros(size, dtype=np.int64)
    if size == 0:
        return longest
    lengths = np.diff(rows)
    ends = np.repeat(rows[1:], lengths)
    rank = np.empty(size, dtype=np.int64)
    live, step = np.arange(size), 1
    order, new, ranks = classes(np.repeat(rows[:-1], lengths), hashes)
    history = []
    while True:
        rank[live[order]] = ranks
        single = new & np.append(new[1:], True)
        live = live[order[~single]]
        history.append((step, rank.copy()))
        if len(live) == 0:
            break
        ahead = live + step
        second = np.where(ahead < ends[live], rank[np.minimum(ahead, size - 1)], -1)
        order, new, ranks = classes(rank[live], second)
        step *= 2
    suffixes = np.empty(size, dtype=np.int64)
    suffixes[rank] = np.arange(size)
    a, b = suffixes[:-1], suffixes[1:]
    known = max((h for h in history if h[0] <= least), key=lambda h: h[0])[1]
    near = known[a] == known[b]
    a, b = a[near], b[near]
    common = np.zeros(len(a), dtype=np.int64)
    for step, known in reversed(history):
        x, y = a + common, b + common
        inside = (x < ends[a]) & (y < ends[b])
        x, y = np.minimum(x, size - 1), np.minimum(y, size - 1)
        common += np.where(inside & (known[x] == known[y]), step, 0)
    common[common < least] = 0
    np.maximum.at(longest, a, common)
    np.maximum.at(longest, b, common)
    return longest


def covered(longest: np.ndarray) -> np.ndarray:
    """Words inside some repeated substring; spans end within their own text."""
    reach = np.arange(len(longest)) + longest
    return np.maximum.accumulate(reach) > np.arange(len(longest))


def sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set between successive bounds."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[bounds])


def repeated_words(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Words in three-word windows that occur twice or more in their text."""
    size = len(hashes)
    text = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    places = np.flatnonzero(np.arange(size) + 3 <= np.repeat(rows[1:], np.diff(rows)))
    inside = np.zeros(size + 3, dtype=bool)
    if len(places):
        runs = words.fold(hashes, places, 3) ^ words.mix(text[places].astype(np.uint64) + words.MULTIPLIER)
        _, which, counts = np.unique(runs, return_inverse=True, return_counts=True)
        again = places[counts[which] > 1]
        for step in range(3):
            inside[again + step] = True
    return inside[:size]


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def judged(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    most_covered: float = MOST_COVERED,
    most_longest: float = MOST_LONGEST,
) -> DataFrame:
    """One row per document: counts of the plain rules, the repeated share and the verdict.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    covered (share of words inside repeated substrings), longest (words of the longest one).
    """
    symbols = np.zeros(256, dtype=bool)
    symbols[list(SYMBOLS)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.flat(batch.column("text"))
            keys = batch.column("doc_id")
            for lo, hi in words.pieces(offsets):
                bounds = offsets[lo : hi + 1] - offsets[lo]
                part = data[offsets[lo] : offsets[hi]]
                found = words.Words(part, bounds)
                hashes, rows = found.hashes(), found.rows
                n = found.counts()
                chars = sums(found.inside & ((part & 0xC0) != 0x80), bounds)
                lines = [
                    repeated_lines(part[x:y].tobytes())
                    for x, y in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                again = sums(repeated_words(hashes, rows), rows)
                longest = repeats(hashes, rows, least)
                share = sums(covered(longest), rows) / np.maximum(n, 1)
                top = np.zeros(len(n), dtype=np.int64)
                filled = np.flatnonzero(n)
                if len(filled):
                    top[filled] = np.maximum.reduceat(longest, rows[:-1][filled])
                failed = (n < 50) | (100 * again > 50 * n)
                kept = ~failed & (share <= most_covered) & (top <= most_longest * n)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(lo, hi - lo),
                        *(pa.array(x) for x in (n, chars, sums(symbols[part], bounds))),
                        pa.array(lines, pa.int64()),
                        *(pa.array(x) for x in (again, failed, kept, share, top)),
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, SCHEMA)


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, covered double, longest long"
)
