"""Document frequencies of a corpus as a stored table, and weights of words from it.

Words fall into a fixed number of slots by their MD5, so the table and the vector of weights have the
same size for every corpus; words that share a slot share its frequency.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import text as X

#: Four hexadecimal digits of the MD5.
SLOTS = 1 << 16
ALL = -1


def slot_of(word: Column) -> Column:
    return F.conv(F.substring(F.md5(word), 1, 4), 16, 10).cast("int")


def slot(word: str) -> int:
    return int(hashlib.md5(word.encode()).hexdigest()[:4], 16)


def write_frequencies(df: DataFrame, path: str, text: str = "content", tokenizer: X.Tokenizer = X.letter_tokens) -> None:
    """(slot, n): in how many rows each slot occurs, and the number of rows under slot -1.

    A row adds to each of its slots once; counts combine map-side into at most ``SLOTS`` rows a task.
    """
    slots = F.array_distinct(F.transform(tokenizer(F.col(text)), slot_of))
    own = F.coalesce(slots, F.array().cast("array<int>"))
    rows = df.select(F.explode(F.concat(F.array(F.lit(ALL)), own)).alias("slot"))
    rows.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, path: str) -> np.ndarray:
    """Per slot floor(1000 ln((N + 1) / (n + 1))) as whole numbers, so that sums do not depend on order."""
    counts = {r.slot: r.n for r in spark.read.schema("slot int, n long").parquet(path).collect()}
    total = counts.get(ALL, 0)
    weights = [math.floor(1000 * math.log((total + 1) / (counts.get(s, 0) + 1))) for s in range(SLOTS)]
    return np.array(weights, dtype=np.int32)


def mean_weight(weights: np.ndarray):
    """Score of a sentence: the mean weight of its words."""
    known: dict[str, int] = {}

    def score(tokens: list[str], wanted: set[str]) -> float:
        if len(known) > SLOTS:
            known.clear()
        total = 0
        for token in tokens:
            if token not in known:
                known[token] = int(weights[slot(token)])
            total += known[token]
        return total / len(tokens)

    return score
