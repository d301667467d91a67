"""Phrase mining over sharded FM-indexes of word ids.

A shard holds the texts of one language that one task has read, up to a bound of words, as a word
list and the sequence of word ids with 0 between pieces. Its index keeps, for depth d, the text
places sorted by the d words that follow (intervals of equal phrases), beside the word before each
place (the Burrows-Wheeler column). One step to the left for all intervals at once is the LF
mapping: a stable sort of those words, which leaves the places sorted by d + 1 words, with the new
intervals in a row. The interval of the phrase without its last word is kept in step (the other
direction of a bidirectional index): a place goes on only where the phrase without its
first and the one without its last word are frequent. Index and counts go no deeper than asked.

Counts are summed across shards level by level. A shard sends each phrase of a level once, packed by
bucket (a hash of the phrase); a bucket sums its parts and answers each shard with one bit per
phrase: frequent in its language or not. Only extensions of frequent phrases are made at
the next level, so rare phrases of three words and more are never sent.

Words and phrases are known by 64-bit codes with the language in them; two of a language with equal
codes would be counted as one.

Null texts are empty, a null language is ``und``. Repeated rows count each time. Nothing depends on
which rows share a shard. Of ids, nothing is read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm import tables, words

SHARD_WORDS = 1 << 19
#: Words of all open shards of a task together; beyond it the largest is closed.
OPEN_WORDS = 1 << 20
#: Words of the whole corpus per bucket: a bucket's group of phrases has at most as many entries.
BUCKET_WORDS = 1 << 20
#: Ways in which a language's phrases are ranked before its last ranking.
WAYS = 8
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
SHARD = "shard long, lang string, n_words long, words binary, ids binary"


class Pieces(words.Words):
    """Words between blanks and breaks, lower-cased; ``opens`` marks a piece's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        breaks = np.zeros(256, dtype=bool)
        breaks[list(BREAKS)] = True
        outside = breaks.copy()
        outside[list(BLANKS)] = True
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        masked = np.where(outside[data], np.uint8(32), lower[data])
        # Other ASCII white space is a break, so nothing else is lost to the parent's rule.
        super().__init__(masked, offsets)
        before = np.concatenate([[0], np.cumsum(breaks[data])])[self.starts]
        row = np.repeat(np.arange(len(offsets) - 1), self.counts())
        self.opens = np.ones(len(self.starts), dtype=bool)
        self.opens[1:] = (before[1:] != before[:-1]) | (row[1:] != row[:-1])


class Open:
    """A shard that is still being filled."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, found: Pieces) -> None:
        if len(found.starts):
            self.parts.append((found.hashes(), found.opens, found.data, found.starts, found.ends))
            self.size += len(found.starts)

    def closed(self, shard: int, lang: str) -> tuple:
        hashes = np.concatenate([p[0] for p in self.parts])
        opens = np.concatenate([p[1] for p in self.parts])
        shift = np.cumsum([0] + [len(p[2]) for p in self.parts])
        data = np.concatenate([p[2] for p in self.parts])
        starts = np.concatenate([p[3] + s for p, s in zip(self.parts, shift, strict=False)])
        ends = np.concatenate([p[4] + s for p, s in zip(self.parts, shift, strict=False)])
        _, first, which, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        # Frequent words get small numbers, whose upper bytes compress to almost nothing.
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(1, len(order) + 1)
        names = b"\n".join(data[starts[i] : ends[i]].tobytes() for i in first[order].tolist())
        ids = np.zeros(len(hashes) + int(opens.sum()), dtype="<u4")
        ids[np.arange(len(hashes)) + np.cumsum(opens)] = rank[which]
        return shard, lang, len(hashes), zlib.compress(names, 1), zlib.compress(planes(ids), 1)


def sequence(row: dict) -> np.ndarray:
    return values(zlib.decompress(row["ids"]), "<u4")


def word_list(row: dict) -> list[bytes]:
    return zlib.decompress(row["words"]).split(b"\n")


def planes(values: np.ndarray) -> bytes:
    """Values as their bytes by significance, which compress better."""
    values = np.ascontiguousarray(values)
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def values(blob: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def rows_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {
        "int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
    }
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The word lists and id sequences of all shards, one row each, as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: dict[str, Open] = {}

        def close(lang: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            return rows_of([held.pop(lang).closed((task << 32) + number, lang)], SHARD)

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in dict.fromkeys(langs.tolist()):
                chosen = batch.column("text").take(pa.array(np.flatnonzero(langs == lang)))
                data, offsets = words.flat(chosen)
                for lo, hi in words.pieces(offsets):
                    held.setdefault(lang, Open()).add(
                        Pieces(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    )
                    if held[lang].size >= shard_words:
                        yield close(lang)
                    while sum(h.size for h in held.values()) > OPEN_WORDS:
                        yield close(max(held, key=lambda x: held[x].size))
        for lang in [x for x in held if held[x].size]:
            yield close(lang)

    chosen = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    return tables.written(chosen.mapInArrow(run, SHARD), "phrase-shards")


class Index:
    """Phrase intervals of one shard, one word deeper with every call of ``extend``."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray):
        self.ids, self.codes = ids.astype(np.int32), codes
        self.depth = 1
        #: Interval of the phrase that starts at each place; -1: none, or not frequent.
        self.label = self.ids - 1
        self.places = np.argsort(self.ids, kind="stable").astype(np.int32)
        self.places = self.places[np.searchsorted(self.ids[self.places], 1) :]

    def extend(self) -> tuple[np.ndarray, np.ndarray]:
        """One word to the left, for all live intervals: an example place and count of each."""
        inside = self.places[(self.places > 0) & (self.label[self.places] >= 0)]
        inside = inside[self.label[inside - 1] >= 0]
        step = np.argsort(self.ids[inside - 1], kind="stable")
        self.places = inside[step] - 1
        symbol, inner = self.ids[self.places], self.label[self.places + 1]
        new = np.ones(len(self.places), dtype=bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (inner[1:] != inner[:-1])
        first = np.flatnonzero(new)
        self.label = np.full(len(self.ids), -1, dtype=np.int32)
        self.label[self.places] = np.cumsum(new, dtype=np.int32) - 1
        self.depth += 1
        return self.places[first], np.diff(np.append(first, len(self.places)))

    def grams(self, at: np.ndarray) -> np.ndarray:
        """Two codes for each phrase that starts at the given places: its first word, the rest."""
        word = [self.codes[self.ids[at + k] - 1] for k in range(self.depth)]
        rest = word[-1]
        for first in word[-2:0:-1]:
            rest = phrase_code(first, rest)
        return np.stack([word[0], rest])

    def keep(self, frequent: np.ndarray) -> None:
        """Drop the intervals of phrases that are not frequent."""
        live = self.label >= 0
        self.label[live] = np.where(frequent[self.label[live]], self.label[live], -1)


def codes_of(row: dict) -> np.ndarray:
    salt = xxhash.xxh3_64_intdigest(row["lang"].encode())
    return np.array([xxhash.xxh3_64_intdigest(w, seed=salt) for w in word_list(row)], dtype=np.uint64)


def phrase_code(first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """A phrase's 64-bit code from the codes of its first word and of the rest."""
    return words.mix(words.mix(rest * words.MULTIPLIER) + first)


def owners(grams: np.ndarray, buckets: int) -> np.ndarray:
    mixed = np.zeros(grams.shape[1], dtype=np.uint64)
    for row in grams:
        mixed = words.mix(mixed * words.MULTIPLIER + row)
    return (mixed % np.uint64(buckets)).astype(np.int64)


def dealing(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Phrases in order of bucket, then of their words; each bucket with its range of them."""
    owner = owners(grams, buckets)
    order = np.lexsort((*grams[::-1], owner))
    owner = owner[order]
    bounds = [0, *(np.flatnonzero(owner[1:] != owner[:-1]) + 1).tolist(), len(owner)] if len(owner) else [0]
    return order, [(int(owner[x]), x, y) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


def word_counts(indexed: DataFrame) -> DataFrame:
    """lang, word, code, f: exact counts of all words, summed across shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = codes_of(row).view(np.int64)
                counts = np.bincount(sequence(row), minlength=len(codes) + 1)[1:]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["lang"]] * len(codes)),
                        pa.array([w.decode() for w in word_list(row)]),
                        pa.array(codes),
                        pa.array(counts, pa.int64()),
                    ],
                    names=["lang", "word", "code", "n"],
                )

    found = indexed.select("lang", "words", "ids").mapInArrow(run, "lang string, word string, code long, n long")
    return found.groupBy("lang", "word", "code").agg(F.sum("n").alias("f"))


PARTS_AT_ONCE = 256
PART = "owner int, shard long, part binary"
ANSWER = "shard long, owner int, bits binary, first long, rest long, code long, f long"
#: A phrase in a part: the codes of its first word and of the rest, and its count.
ENTRY_BYTES = 20


def sent(indexed: DataFrame, answers: list[DataFrame], buckets: int) -> DataFrame:
    """Each shard's phrases of the next level with their counts, packed by bucket.

    ``answers`` holds the buckets' bits for every level so far, from two words on.
    """
    depth = len(answers) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                index = Index(sequence(row), codes_of(row))
                for level in range(2, depth):
                    at, _ = index.extend()
                    order, found = dealing(index.grams(at), buckets)
                    bits = {x["owner"]: x["bits"] for x in row[f"bits{level}"] or []}
                    frequent = np.zeros(len(at), dtype=bool)
                    for owner, x, y in found:
                        frequent[order[x:y]] = np.unpackbits(np.frombuffer(bits[owner], np.uint8), count=y - x)
                    index.keep(frequent)
                at, counts = index.extend()
                grams = index.grams(at)
                order, found = dealing(grams, buckets)
                grams, counts = grams[:, order], counts[order].astype("<u4")
                for k in range(0, len(found), PARTS_AT_ONCE):
                    parts = [
                        (owner, row["shard"], b"".join([*(planes(g[x:y]) for g in grams), planes(counts[x:y])]))
                        for owner, x, y in found[k : k + PARTS_AT_ONCE]
                    ]
                    yield rows_of(parts, PART)

    asked = indexed.select("shard", "lang", "words", "ids")
    for level, answer in enumerate(answers, start=2):
        told = (
            answer.where(F.col("bits").isNotNull())
            .groupBy(F.col("shard").alias("s"))
            .agg(F.collect_list(F.struct("owner", "bits")).alias(f"bits{level}"))
        )
        asked = asked.join(told, F.col("shard") == F.col("s"), "left").drop("s")
    return asked.mapInArrow(run, PART)


def summed(parts: DataFrame, least: int) -> DataFrame:
    """Add up each bucket: bits for every shard that sent a part, and the frequent phrases."""

    def run(table: pa.Table) -> pa.Table:
        blobs = table["part"].to_pylist()
        sizes = [len(b) // ENTRY_BYTES for b in blobs]
        ends = list(zip(blobs, sizes, strict=True))
        first = np.concatenate([values(b[: 8 * n], "<u8") for b, n in ends])
        rest = np.concatenate([values(b[8 * n : 16 * n], "<u8") for b, n in ends])
        counts = np.concatenate([values(b[16 * n :], "<u4") for b, n in ends])
        del blobs, ends
        order = np.lexsort((rest, first))
        first, rest = first[order], rest[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])
        starts = np.flatnonzero(new)
        total = np.add.reduceat(counts[order].astype(np.int64), starts)
        frequent = np.zeros(len(order), dtype=bool)
        frequent[order] = (total >= least)[np.cumsum(new) - 1]
        owner, rows, at = table["owner"][0].as_py(), [], 0
        for shard, n in zip(table["shard"].to_pylist(), sizes, strict=True):
            rows.append((shard, owner, np.packbits(frequent[at : at + n]).tobytes(), None, None, None, None))
            at += n
        kept = starts[total >= least]
        codes = [x.view(np.int64).tolist() for x in (first[kept], rest[kept], phrase_code(first[kept], rest[kept]))]
        rows.extend((None, None, None, *x) for x in zip(*codes, total[total >= least].tolist(), strict=True))
        return pa.Table.from_batches([rows_of(rows, ANSWER)])

    return parts.groupBy("owner").applyInArrow(run, ANSWER)


def frequent_phrases(docs: DataFrame, least: int, longest: int, shard_words: int = SHARD_WORDS) -> tuple:
    """Word counts (lang, word, code, f), words per lang (lang, n), and for each length from two
    words on the phrases with ``least`` or more occurrences (gram, f)."""
    indexed = shards(docs, shard_words)
    # One number comes to the driver; buckets grow with the corpus, so their groups do not.
    total = indexed.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_WORDS + 1)
    counted = tables.written(word_counts(indexed).where(F.col("f") >= least), "phrase-words")
    totals = indexed.groupBy("lang").agg(F.sum("n_words").alias("n"))
    answers, levels = [], []
    rests = counted.select(F.col("code").alias("rest"), F.array("code").alias("tail"))
    for depth in range(2, longest + 1):
        answers.append(tables.written(summed(sent(indexed, answers, buckets), least), f"phrases-{depth}"))
        level = answers[-1].where(F.col("first").isNotNull()).join(rests, "rest")
        level = level.select("code", F.concat(F.array("first"), "tail").alias("gram"), "f")
        levels.append(level.select("gram", "f"))
        rests = level.select(F.col("code").alias("rest"), F.col("gram").alias("tail"))
    return counted, totals, levels


def wide(x: Column) -> Column:
    return x.cast("decimal(19,0)")


def collocations(
    docs: DataFrame,
    least: int = 10,
    longest: int = 3,
    absorb_percent: int = 50,
    top: int | None = 2000,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``longest`` words with a >= ``least`` occurrences is cut after each of its
    words; with l and r occurrences of the two parts a cut scores floor(1000000 a a / (l r)) and the
    lowest score counts. Phrases inside a longer one that has at least ``absorb_percent`` of their
    occurrences go (the longer one by a word is enough to look at: any other is rarer). Products of
    counts are exact up to 38 digits.
    """
    counted, totals, levels = frequent_phrases(docs, least, longest, shard_words)
    known = counted.select(F.array("code").alias("gram"), "f", "lang", F.col("word").alias("phrase"))
    lower, named = [known], known
    out = []
    for depth, level in enumerate(levels, start=2):
        # The name and language come from the parts, the counts of both parts of each cut as well.
        here = level.withColumnRenamed("f", "a")
        for k in range(1, depth):
            left = lower[k - 1].select(F.col("gram").alias("lg"), F.col("f").alias(f"l{k}"), "lang", F.col("phrase").alias("lp"))
            right = lower[depth - k - 1].select(F.col("gram").alias("rg"), F.col("f").alias(f"r{k}"), F.col("phrase").alias("rp"))
            if k > 1:
                left, right = left.drop("lang", "lp"), right.drop("rp")
            here = here.join(left, F.slice("gram", 1, k) == F.col("lg")).drop("lg")
            here = here.join(right, F.slice("gram", k + 1, depth - k) == F.col("rg")).drop("rg")
        here = here.withColumn("phrase", F.concat_ws(" ", "lp", "rp")).drop("lp", "rp")
        named = tables.written(here, f"phrases-named-{depth}")
        lower.append(named.select("gram", F.col("a").alias("f"), "lang", "phrase"))
        cuts = [
            F.struct(
                F.expr(f"(1000000 * CAST(a AS DECIMAL(19,0)) * a) div (CAST(l{k} AS DECIMAL(19,0)) * r{k})").alias("score"),
                F.lit(k).alias("k"),
                F.col(f"l{k}").alias("l"),
                F.col(f"r{k}").alias("r"),
            )
            for k in range(1, depth)
        ]
        cut = F.array_min(F.array(*cuts))
        out.append(named.select("gram", "lang", "phrase", "a", cut.alias("cut")))
    kept = []
    for depth, part in enumerate(out, start=2):
        if depth < longest:
            longer = levels[depth - 1]
            inside = (
                longer.select(F.slice("gram", 1, depth).alias("g"), "f")
                .unionByName(longer.select(F.slice("gram", 2, depth).alias("g"), "f"))
                .groupBy("g")
                .agg(F.max("f").alias("longer"))
            )
            part = part.join(inside, F.col("gram") == F.col("g"), "left").where(
                F.coalesce(100 * F.col("longer") < absorb_percent * F.col("a"), F.lit(True))
            )
        kept.append(part.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    every = kept[0]
    for part in kept[1:]:
        every = every.unionByName(part)
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    if top is not None:
        # Ranked in ways first, so that the task of a language reads WAYS * top rows at most.
        some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(WAYS))).orderBy(*best)
        every = every.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    order = Window.partitionBy("lang").orderBy(*best)
    ranked = every.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
