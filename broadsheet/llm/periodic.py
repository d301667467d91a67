"""Periodic runs of words by an online, sparse diagonal table.

Cell (i, q) of the table holds how many words up to word i equal the word q places before. Only
cells that can grow into a run are kept: at each power of two L a word's cell is the lag of the
latest earlier occurrence of the block of L words that ends there, and only lags q with
L/2 < q <= L count. Inside a run of smallest period q a block of L >= q words cannot return
sooner than after q words, so the run's diagonal is one unbroken stretch of such cells, and a
word has at most one cell per L: the table stays linear in the words for each L, however
often a word occurs. While the lag repeats from word to word the match length grows by one; where
it changes the diagonal ends and, if long enough, its run is emitted. Lags that are
multiples of the smallest period never occur, so each run comes out once.

Texts are worked on in bounded batches, one text is never cut. Null, empty and word-less texts
have no words and no runs; equal rows give equal results; a null id is passed through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import words

#: Fewest words of a run, and how often its period must fit in.
LEAST_WORDS = 6
LEAST_TIMES = 4

SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
)


def stretches(cells: np.ndarray, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unbroken diagonals: first word, number of cells, lag."""
    new = np.ones(len(cells), dtype=bool)
    new[1:] = (cells[1:] != cells[:-1] + 1) | (lags[1:] != lags[:-1])
    first = np.flatnonzero(new)
    return cells[first], np.diff(np.append(first, len(cells))), lags[first]


def runs_of(
    hashes: np.ndarray, rows: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run, by start and then period.

    ``rows`` bounds the texts in the array of word hashes; ``times`` is 3 or more, which
    makes a run's smallest period the only lag its cells can have.
    """
    if times < 3:
        raise ValueError("a run must hold its period three times or more")
    size = len(hashes)
    lengths = np.diff(rows)
    begins = np.repeat(rows[:-1], lengths)
    salt = words.mix(np.arange(len(lengths), dtype=np.uint64) + words.MULTIPLIER)
    block = words.mix(hashes ^ np.repeat(salt, lengths))
    live, width, found = np.arange(size), 1, []
    while len(live):
        order = np.argsort(block[live], kind="stable")
        ends = live[order]
        same = block[ends[1:]] == block[ends[:-1]]
        lag = np.zeros(size, dtype=np.int64)
        lag[ends[1:][same]] = (ends[1:] - ends[:-1])[same]
        cells = np.flatnonzero((lag > width // 2) & (lag <= width))
        first, count, period = stretches(cells, lag[cells])
        length = count + width - 1 + period
        long = length >= np.maximum(least, times * period)
        found.append(np.stack([first - width + 1 - period, length, period])[:, long])
        again = np.zeros(size, dtype=bool)
        again[ends[1:][same]] = True
        again[ends[:-1][same]] = True
        live = np.flatnonzero(again)
        live = live[live - begins[live] >= 2 * width - 1]
        live = live[again[live - width]]
        block[live] = words.mix(block[live] * words.MULTIPLIER + block[live - width])
        width *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def repeats_dropped(size: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words stay when every run is cut back to its first period."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:size]) == 0


def detected(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    times: int = LEAST_TIMES,
    rewrite: Callable[[int | None, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """One row per document: n_words, its runs, and the text with each run cut to one period.

    doc_id, n_words, runs (by start, then period; word numbers from 0), collapsed (kept words
    joined by one space). ``rewrite(doc_id, n_words)`` may name, for each word place, the word
    that is to stand there before runs are looked for; None leaves the text as it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.flat(batch.column("text"))
            keys = batch.column("doc_id")
            for lo, hi in words.pieces(offsets):
                part = data[offsets[lo] : offsets[hi]]
                bounds = offsets[lo : hi + 1] - offsets[lo]
                found = words.Words(part, bounds)
                hashes, rows = found.hashes(), found.rows
                n = found.counts()
                source = np.arange(len(hashes)) - np.repeat(rows[:-1], n)
                if rewrite:
                    for i, key in enumerate(keys.slice(lo, hi - lo).to_pylist()):
                        other = rewrite(key, int(n[i]))
                        if other is not None:
                            source[rows[i] : rows[i + 1]] = other
                hashes = hashes[np.repeat(rows[:-1], n) + source]
                start, length, period = runs_of(hashes, rows, least, times)
                stays = repeats_dropped(len(hashes), start, length, period)
                texts = []
                for i, (x, y) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    mine = slice(rows[i], rows[i + 1])
                    tokens = part[x:y].tobytes().split()
                    if rewrite or not stays[mine].all():
                        tokens = [tokens[j] for j in source[mine][stays[mine]].tolist()]
                    texts.append(b" ".join(tokens))
                spans = pa.StructArray.from_arrays(
                    [
                        pa.array(start - rows[np.searchsorted(rows, start, side="right") - 1]),
                        pa.array(length),
                        pa.array(period),
                    ],
                    names=["start", "length", "period"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(lo, hi - lo),
                        pa.array(n),
                        pa.ListArray.from_arrays(pa.array(np.searchsorted(start, rows), pa.int32()), spans),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, SCHEMA)
