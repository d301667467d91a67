"""Benchmark decontamination with spaced seeds.

A mask reads some of the words in a window and ignores the others, so a window still hits when
words at ignored places were replaced. All masks are laid on every place of the documents and
of the benchmark items; equal hashes (same mask, same words read) join them. Around each hit
the two texts are aligned word by word and the longest stretches with at least ``LEAST_WORDS``
matching words and ``PERCENT`` of their words equal are taken; any such stretch of an
alignment makes the item contaminate the document.

The benchmark is sent to the tasks in blocks of at most ``BLOCK_WORDS`` words (a proven bound,
some 30 MB with its hashes); each block is one pass over the documents, so a benchmark of any
size works and documents never move.

Words are lower-cased (all letters, not only a to z). Null or empty texts and items match nothing; nor do items with fewer
words than a mask spans. Rows with a null id are scanned as any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import words

#: 1: the word is read, 0: it is ignored.
MASKS = ("1101100111", "1110010111", "1011111001", "11101111")
LEAST_WORDS = 12
PERCENT = 80
BLOCK_WORDS = 500_000
BLOCK_CHARS = 16_000_000
FILTER_BITS = 22


def seeded(hashes: np.ndarray, ends: np.ndarray, mask: str, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where the mask fits before the text's end, and the hash of the words it reads."""
    places = np.flatnonzero(np.arange(len(hashes)) + len(mask) <= ends)
    value = np.full(len(places), np.uint64(salt + 1), np.uint64)
    for offset, read in enumerate(mask):
        if read == "1":
            value = (value ^ hashes[places + offset]) * words.MULTIPLIER
            value ^= value >> np.uint64(29)
    return places, value


class Block:
    """The seeds of some benchmark items, sorted, with a bit filter in front."""

    def __init__(self, ids: list[int], texts: list[str]):
        data, offsets = words.flat(pc.utf8_lower(pa.array(texts, pa.string())))
        found = words.Words(data, offsets)
        self.ids, self.rows = ids, found.rows
        self.hashes = found.hashes()
        self.item = np.repeat(np.arange(len(ids)), found.counts())
        ends = np.repeat(found.rows[1:], found.counts())
        parts = [seeded(self.hashes, ends, m, i) for i, m in enumerate(MASKS)]
        places = np.concatenate([p for p, _ in parts])
        seeds = np.concatenate([s for _, s in parts])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.places = seeds[order], places[order]
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[(self.seeds >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in the documents, place in the items) with an equal seed."""
        left, right = [], []
        for number, mask in enumerate(MASKS):
            places, value = seeded(hashes, ends, mask, number)
            maybe = self.filter[(value >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
            places, value = places[maybe], value[maybe]
            lo = np.searchsorted(self.seeds, value, "left")
            hi = np.searchsorted(self.seeds, value, "right")
            counts = hi - lo
            inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            left.append(np.repeat(places, counts))
            right.append(self.places[np.repeat(lo, counts) + inner])
        return np.concatenate(left), np.concatenate(right)


def stretch(equal: np.ndarray) -> tuple[int, int] | None:
    """Start and end of the longest run of an alignment that meets both limits, if any.

    Cutting replaced words off a run's ends leaves a run that meets the limits as well, so only
    runs from a match to a match are looked at. For each end the earliest start at which the
    balance is no higher gives the longest run and the most matches.
    """
    at = np.flatnonzero(equal)
    if len(at) < LEAST_WORDS:
        return None
    balance = np.concatenate([[0], np.cumsum(np.where(equal, 100 - PERCENT, -PERCENT))])
    low = np.minimum.accumulate(balance[at])
    first = np.searchsorted(-low, -balance[at + 1], "left")
    met = np.flatnonzero(np.arange(len(at)) - first + 1 >= LEAST_WORDS)
    if len(met) == 0:
        return None
    best = met[np.argmax(at[met] - at[first[met]])]
    return int(at[first[best]]), int(at[best]) + 1


def overlaps(block: Block, hashes: np.ndarray, lo: int, hi: int, at: np.ndarray, to: np.ndarray):
    """Stretches in the words lo..hi of a text, as (item, start, end, matches).

    Hits on one alignment (same item, same shift) are looked at once; after a stretch is taken
    what remains on its left and right is looked at again.
    """
    pairs = {(int(i), int(s)) for i, s in zip(block.item[to], at - to, strict=True)}
    for item, shift in sorted(pairs):
        first = max(block.rows[item], lo - shift)
        last = min(block.rows[item + 1], hi - shift)
        parts = [(first, last)]
        while parts:
            a, b = parts.pop()
            if b - a < LEAST_WORDS:
                continue
            equal = hashes[a + shift : b + shift] == block.hashes[a:b]
            run = stretch(equal)
            if run is None:
                continue
            start, end = run
            matches = int(equal[start:end].sum())
            yield item, a + start + shift - lo, a + end + shift - lo, a + start, a + end, matches
            parts += [(a, a + start), (a + end, b)]


SCHEMA = (
    "doc_id long, item_id long, n_overlaps int, n_matched int, item_share double, "
    "first_word int, last_word int"
)


def scan(docs: DataFrame, block: Block) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            data, offsets = words.flat(pc.utf8_lower(batch.column("text")))
            keys = batch.column("doc_id")
            out = []
            for lo, hi in words.pieces(offsets):
                found = words.Words(
                    data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                )
                hashes, rows = found.hashes(), found.rows
                ends = np.repeat(rows[1:], found.counts())
                at, to = items.hits(hashes, ends)
                text = np.searchsorted(rows, at, side="right") - 1
                for one in np.unique(text):
                    mine = text == one
                    per_item = {}
                    for row in overlaps(items, hashes, rows[one], rows[one + 1], at[mine], to[mine]):
                        per_item.setdefault(row[0], []).append(row[1:])
                    for item, spans in per_item.items():
                        seen = np.zeros(items.rows[item + 1] - items.rows[item], dtype=bool)
                        for _, _, a, b, _ in spans:
                            seen[a - items.rows[item] : b - items.rows[item]] = True
                        best = max(spans, key=lambda s: (s[4], -s[0]))
                        out.append(
                            (
                                keys[lo + int(one)].as_py(),
                                items.ids[item],
                                len(spans),
                                best[4],
                                float(seen.mean()),
                                int(best[0]),
                                int(best[1]),
                            )
                        )
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, SCHEMA)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that overlap; see SCHEMA.

    n_matched, first_word and last_word (exclusive) describe the longest stretch, item_share
    the part of the item's words that all stretches cover.
    """
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("text IS NOT NULL")
    found, ids, texts, size, chars = None, [], [], 0, 0
    for row in items.toLocalIterator():
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text.split())
        chars += len(row.text)
        if size >= BLOCK_WORDS or chars >= BLOCK_CHARS:
            part = scan(docs, Block(ids, texts))
            found = part if found is None else found.union(part)
            ids, texts, size, chars = [], [], 0, 0
    if ids or found is None:
        part = scan(docs, Block(ids, texts))
        found = part if found is None else found.union(part)
    return found
