"""Lines that many documents share: hashes sorted over range partitions, keep bitmaps back.

Each line's key (ASCII white space stripped, A-Z lower-cased) is hashed to 128 bits. The entries
(hash, document, position) are range-partitioned by all of these and sorted inside each
partition, so a very common line is spread over as many partitions as its entries fill. A task
streams its sorted entries: a key's first occurrence comes first, and as soon as ``least_docs``
documents have been seen its entries are passed on as dropped; a task holds the entries of fewer
documents than that. Only a partition's first and last key can go on in a neighbour: their
number of documents is summed over the partitions (two rows each) and entries still undecided,
of fewer than ``least_docs`` documents per partition, wait for that sum.

Back come compressed bitmaps per document, not texts: bit i of ``keep`` tells whether line i stays,
lines beyond its end stay. Documents without a bitmap stay whole.

Every row counts as a document, repeated rows and null ids too. Rows with equal id and equal text
are one entry of the bitmap table, and the same lines go in each. Null and empty texts are one
empty line; keys of fewer than ``least_chars`` code points are never dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import tables

SPACE = b" \t\n\x0b\x0c\r"
KEY = ("high", "low")
PLACE = ("doc_id", "text_hash", "line")
ENTRY = "high long, low long, doc_id long, text_hash long, line int, first boolean"
#: What the stream over sorted entries says: an entry to drop, one that waits for its key's sum,
#: or the number of documents and the first occurrence of a partition's first or last key.
DROP, WAIT, EDGE = 0, 1, 2
JUDGED = "kind int, high long, low long, docs long, doc_id long, text_hash long, line int"
AT_ONCE = 1 << 16


def identified(docs: DataFrame) -> DataFrame:
    """Id, text and a hash that tells texts of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )


def key_of(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def entries(docs: DataFrame, least_chars: int) -> DataFrame:
    """One row per line whose key is long enough; ``first`` marks a key's first line in its row."""

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=[c.split()[0] for c in ENTRY.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            for i, (doc_id, text_hash) in enumerate(zip(ids, hashes, strict=True)):
                seen = set()
                for number, line in enumerate(texts[i].as_py().split(b"\n")):
                    key = key_of(line)
                    if not key or len(key.decode()) < least_chars:
                        continue
                    digest = xxhash.xxh3_128_digest(key)
                    high = int.from_bytes(digest[:8], "big", signed=True)
                    low = int.from_bytes(digest[8:], "big", signed=True)
                    out.append((high, low, doc_id, text_hash, number, digest not in seen))
                    seen.add(digest)
                    if len(out) == AT_ONCE:
                        yield batch_of(out)
                        out = []
        yield batch_of(out)

    return docs.mapInArrow(run, ENTRY)


def judged(sorted_entries: DataFrame, least_docs: int, spare_first: bool) -> DataFrame:
    """Stream each partition's sorted entries once; see DROP, WAIT and EDGE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key = first = None
        docs, waiting, opening = 0, [], True

        def close(closing: bool) -> None:
            """End of a key's entries in this partition."""
            if key is not None and (opening or closing):
                out.append((EDGE, *key, docs, *first))
                out.extend((WAIT, *key, None, *place) for place in waiting)

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = [pa.int32()] + [pa.int64()] * 5 + [pa.int32()]
            done = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[c.split()[0] for c in JUDGED.split(", ")],
            )
            out.clear()
            return done

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*KEY, *PLACE, "first")]
            for high, low, *place, fresh in zip(*columns, strict=True):
                if (high, low) != key:
                    if key is not None:
                        close(False)
                        opening = False
                    key, first, docs, waiting = (high, low), place, 0, []
                docs += fresh
                # The first key of a partition may go on from the one before: its first
                # occurrence there is settled with the edges.
                if not (spare_first and place is first and not opening):
                    waiting.append(place)
                if docs >= least_docs:
                    out.extend((DROP, *key, None, *p) for p in waiting)
                    waiting = []
            if len(out) >= AT_ONCE:
                yield ready()
        close(True)
        yield ready()

    return sorted_entries.mapInArrow(run, JUDGED)


def dropped_lines(docs: DataFrame, least_docs: int, least_chars: int, spare_first: bool = False) -> DataFrame:
    """doc_id, text_hash, line of every line that goes.

    Entries are written before the range partitioning, which reads them twice (once for its
    sample); so is what the stream says, because its edges are read twice.
    """
    found = tables.written(entries(identified(docs), least_chars), "line-entries")
    dealt = found.repartitionByRange(*KEY, *PLACE).sortWithinPartitions(*KEY, *PLACE)
    said = tables.written(judged(dealt, least_docs, spare_first), "line-verdicts")
    edges = (
        said.where(F.col("kind") == EDGE)
        .groupBy(*KEY)
        .agg(F.sum("docs").alias("docs"), F.min(F.struct(*PLACE)).alias("first"))
        .where(F.col("docs") >= least_docs)
    )
    waiting = said.where(F.col("kind") == WAIT).select(*KEY, *PLACE)
    late = waiting.join(edges.select(*KEY), list(KEY), "left_semi")
    gone = said.where(F.col("kind") == DROP).select(*PLACE).unionByName(late.select(*PLACE))
    if spare_first:
        firsts = edges.select(*[F.col(f"first.{c}").alias(f"f_{c}") for c in PLACE])
        same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in PLACE]
        gone = gone.join(firsts, same, "left_anti")
    return gone


def keep_bitmaps(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, spare_first: bool = False) -> DataFrame:
    """doc_id, text_hash, keep: the compressed bitmap of each document that loses lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for lines in batch.column("lines"):
                gone = np.array(lines.values, dtype=np.int64)
                keep = np.ones((gone.max() // 8 + 1) * 8, dtype=bool)  # whole bytes; lines past them stay
                keep[gone] = False
                maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(maps, pa.binary())],
                names=["doc_id", "text_hash", "keep"],
            )

    grouped = (
        dropped_lines(docs, least_docs, least_chars, spare_first)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list("line").alias("lines"))
    )
    return grouped.mapInArrow(run, "doc_id long, text_hash long, keep binary")


def applied(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept: each document with the lines its bitmap keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, maps = batch.column("text").cast(pa.binary()), batch.column("keep")
            counts, gone, kept = [], [], []
            for i in range(len(batch)):
                text = texts[i].as_py()
                keep = maps[i].as_py()
                n = text.count(b"\n") + 1
                lost = 0
                if keep is not None:
                    lines = text.split(b"\n")
                    flags = np.ones(n, dtype=bool)
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
                    flags[: min(n, len(bits))] = bits[:n]
                    lost = n - int(flags.sum())
                    text = b"\n".join([line for line, stays in zip(lines, flags, strict=True) if stays])
                counts.append(n)
                gone.append(lost)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_lines", "n_dropped", "kept"],
            )

    here = identified(docs)
    maps = bitmaps.select(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash"), "keep")
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash"))
    joined = here.join(maps.hint("shuffle_hash"), same, "left").select("doc_id", "text", "keep")
    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept string")


def deduplicated(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, spare_first: bool = False) -> DataFrame:
    """Each document without the lines that ``least_docs`` or more documents hold.

    With ``spare_first`` the first occurrence of such a line (by id, text hash, position) stays.
    """
    return applied(docs, keep_bitmaps(docs, least_docs, least_chars, spare_first))
