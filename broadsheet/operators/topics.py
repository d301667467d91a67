"""Topics from anchor words: the same rows for any layout of the input.

Co-occurrence counts of keywords are whole numbers, so their sums do not depend on the order or the
partitioning of rows. From there on the work has a fixed size and order: anchors are the rows of the
normalised counts that stand out most once earlier anchors are projected away, and every
word is the mixture of anchors that comes nearest to its row.

The vocabulary is all terms found in at least ``least_share`` of the rows. With n keywords a row that
are at most n / ``least_share`` terms whatever the corpus, which bounds the matrix on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import text as X

LEAST_SHARE = 0.01
STEPS = 300
DIGITS = 12


@dataclass
class TopicModel:
    terms: list[str]
    mixtures: np.ndarray
    """Share of each topic in each term."""
    counts: np.ndarray
    """Rows that hold each term."""
    anchors: list[str]

    def words(self, n: int = 10) -> list[list[str]]:
        """Most probable terms of each topic; ties by term."""
        weight = np.round(self.mixtures * self.counts[:, None], DIGITS)
        return [[self.terms[i] for i in np.lexsort((np.arange(len(self.terms)), -weight[:, k]))[:n]] for k in range(len(self.anchors))]


def vocabulary(df: DataFrame, least_share: float = LEAST_SHARE) -> list[tuple[str, int]]:
    """Terms found in at least ``least_share`` of the rows with their number of rows, by term."""
    listed = F.explode(F.concat(F.array(F.lit("")), F.coalesce(F.array_distinct("keywords"), F.array().cast("array<string>"))))
    counts = df.select(listed.alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    total = counts.where("term = ''").select("n").first()
    least = least_share * (total.n if total else 0)
    return [(r.term, r.n) for r in counts.where((F.col("term") != "") & (F.col("n") >= least)).orderBy("term").collect()]


def cooccurrence(df: DataFrame, terms: list[str]) -> DataFrame:
    """(a, b, n): in how many rows two terms stand together, a before b in order.

    Pairs are made within a row's few keywords, and counted with map-side combine.
    """
    known = F.array_sort(F.filter(F.array_distinct("keywords"), lambda k: k.isin(terms)))

    def pairs_of(ks: Column) -> Column:
        return F.transform(ks, lambda a, i: F.transform(F.slice(ks, i + 2, F.size(ks)), lambda b: F.struct(a.alias("a"), b.alias("b"))))

    pairs = F.flatten(X.let(known, pairs_of))
    return df.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))


def anchor_rows(rows: np.ndarray, k: int) -> list[int]:
    """Row numbers of the anchors: the longest row, then the longest once the others are projected away.

    Lengths are compared after rounding; of equal ones the first row counts.
    """
    left, chosen = rows.copy(), []
    for _ in range(min(k, len(rows))):
        size = np.round((left * left).sum(axis=1), DIGITS)
        best = int(np.argmax(size))
        if size[best] == 0:
            break
        chosen.append(best)
        unit = left[best] / np.sqrt((left[best] * left[best]).sum())
        left = left - np.outer(left @ unit, unit)
    return chosen


def onto_simplex(points: np.ndarray) -> np.ndarray:
    """Nearest point of the simplex for every row."""
    ordered = -np.sort(-points, axis=1)
    excess = (np.cumsum(ordered, axis=1) - 1) / np.arange(1, points.shape[1] + 1)
    last = (ordered > excess).sum(axis=1) - 1
    return np.maximum(points - excess[np.arange(len(points)), last][:, None], 0)


def mixtures_of(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """For every row the mixture of anchors nearest to it, by projected gradient steps."""
    gram, goal = anchors @ anchors.T, rows @ anchors.T
    step = 1 / max(float(np.linalg.eigvalsh(gram)[-1]), 1e-12)
    mix = np.full((len(rows), len(anchors)), 1 / len(anchors))
    for _ in range(STEPS):
        mix = onto_simplex(mix - step * (mix @ gram - goal))
    return mix


def matrix_of(pairs: list, terms: list[str]) -> np.ndarray:
    place = {t: i for i, t in enumerate(terms)}
    counts = np.zeros((len(terms), len(terms)))
    for row in pairs:
        counts[place[row.a], place[row.b]] = counts[place[row.b], place[row.a]] = row.n
    return counts


def fit(df: DataFrame, k: int = 5, least_share: float = LEAST_SHARE) -> TopicModel:
    """Fit on all rows of ``keywords``. Terms that stand with no other term are left out."""
    found = vocabulary(df, least_share)
    terms = [t for t, _ in found]
    counts = matrix_of(cooccurrence(df, terms).collect() if terms else [], terms)
    alone = counts.sum(axis=1) == 0
    terms = [t for t, out in zip(terms, alone, strict=True) if not out]
    rows = np.array([n for _, n in found], dtype=float)[~alone]
    counts = counts[~alone][:, ~alone]
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    chosen = anchor_rows(shares, k) if terms else []
    mix = mixtures_of(shares, shares[chosen]) if chosen else np.zeros((len(terms), 0))
    return TopicModel(terms, mix, rows, [terms[i] for i in chosen])


def save(spark: SparkSession, model: TopicModel, path: str) -> None:
    rows = [
        (t, m.tolist(), float(n), model.anchors.index(t) if t in model.anchors else None)
        for t, m, n in zip(model.terms, model.mixtures, model.counts, strict=True)
    ]
    frame = spark.createDataFrame(rows, "term string, mixture array<double>, n double, anchor int")
    frame.coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> TopicModel:
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r.term)
    anchors = [r.term for r in sorted((r for r in rows if r.anchor is not None), key=lambda r: r.anchor)]
    mix = np.array([r.mixture for r in rows]).reshape(len(rows), len(anchors))
    return TopicModel([r.term for r in rows], mix, np.array([r.n for r in rows]), anchors)


def distribution_of(keywords: Column, model: TopicModel) -> Column:
    """Mean mixture of a row's known keywords; equal shares where none is known."""
    place = {t: i for i, t in enumerate(model.terms)}
    mix, k = model.mixtures, len(model.anchors)

    @F.pandas_udf("array<double>")
    def mean(lists: pd.Series) -> pd.Series:
        out = []
        for words in lists:
            known = [place[w] for w in (words if words is not None else ()) if w in place]
            out.append((mix[known].sum(axis=0) / len(known)).tolist() if known else [1 / k] * k)
        return pd.Series(out, dtype=object)

    return mean(keywords)


def analyse(df: DataFrame, model: TopicModel, words: int = 10) -> DataFrame:
    """Add ``topic_analysis``: distribution, main topics (above an equal share, best first), topic words."""
    k = len(model.anchors)
    pairs = [x for t, ws in enumerate(model.words(words)) for x in (F.lit(str(t)), F.array(*[F.lit(w) for w in ws]))]
    once = df.withColumn("_topics", distribution_of(F.col("keywords"), model))
    ranked = F.sort_array(F.transform("_topics", lambda p, i: F.struct((-p).alias("neg"), i.alias("topic"))))
    main = F.transform(F.filter(ranked, lambda t: -t["neg"] > 1.0 / k + 1e-9), lambda t: t["topic"])
    topic = F.struct(F.col("_topics").alias("topic_distribution"), main.alias("main_topics"), F.create_map(*pairs).alias("topic_keywords"))
    return once.withColumn("topic_analysis", topic).drop("_topics")
