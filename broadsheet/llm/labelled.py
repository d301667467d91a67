"""Bounded training samples from a table of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out():
    """True where crc32 of the id as text leaves no remainder by FOLDS."""
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0


def training_rows(labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """At most ``per_class`` (doc_id, label) rows of each class outside the held-out fold.

    Rows are picked by a hash of the id, the same at every run. Null ids and labels are left
    out; an id with several labels has the largest.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    parts = [
        known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for value in (0, 1)
    ]
    return parts[0].union(parts[1])


def labelled_texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the sampled rows; the sample is small by its bound."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.join(F.broadcast(rows), "doc_id")
