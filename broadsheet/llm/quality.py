"""Quality scores by Bradley-Terry ranking of document pairs.

Each document has a strength, linear in features of its whole text; a document labelled good is
preferred to one labelled bad with the logistic of the difference of their strengths. The
weights are learned from such preference pairs by logistic loss on feature differences. The
threshold is a quantile of strength: the share of bad documents among all labelled training
rows. A score is the logistic of the distance from that threshold, scaled so that the threshold
itself has the score 0.3.

Texts without words (null, empty) have score 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import labelled, repetition, words

#: Bounds of the training sample.
ROWS_PER_CLASS = 5000
PAIRS = 60_000
STEPS = 400
RATE = 0.5
RIDGE = 1e-4
AT_THRESHOLD = 0.3
N_FEATURES = 16


def marks(chosen: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chosen)] = True
    return table


def features(column: pa.Array) -> np.ndarray:
    """One row per text: shares of kinds of characters, words, lines and repeats."""
    data, offsets = words.flat(column)
    kinds = [
        marks(bytes(range(65, 91))),
        marks(b"0123456789"),
        marks(repetition.SYMBOLS),
        marks(b"!?"),
        marks(b".,;:"),
        marks(b"|"),
        marks(bytes(range(128, 256))),
        marks(b"\n"),
    ]
    rows = []
    for lo, hi in words.pieces(offsets):
        part = data[offsets[lo] : offsets[hi]]
        bounds = offsets[lo : hi + 1] - offsets[lo]
        found = words.Words(part, bounds)
        n = np.maximum(found.counts(), 1)
        size = np.maximum(np.diff(bounds), 1)
        hashes = found.hashes()
        text = np.repeat(np.arange(len(n)), found.counts())
        different = np.bincount(
            text[np.unique(hashes ^ words.mix(text.astype(np.uint64) + words.MULTIPLIER), return_index=True)[1]],
            minlength=len(n),
        )
        lengths = found.ends - found.starts
        mean_length = np.bincount(text, lengths, len(n)) / n
        long_words = np.bincount(text, lengths > 20, len(n)) / n
        last = part[found.ends - 1] if len(lengths) else np.zeros(0, np.uint8)
        symbol_end = np.bincount(text, kinds[2][last] | kinds[3][last], len(n)) / n
        lines = [
            repetition.repeated_lines(part[x:y].tobytes())
            for x, y in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        breaks = np.maximum(repetition.sums(kinds[7][part], bounds) + 1, 1)
        rows.append(
            np.stack(
                [repetition.sums(k[part], bounds) / size for k in kinds[:7]]
                + [
                    np.log1p(found.counts()),
                    np.log1p(n / breaks),
                    mean_length,
                    long_words,
                    symbol_end,
                    different / n,
                    np.array(lines) / breaks,
                    repetition.sums(repetition.repeated_words(hashes, found.rows), found.rows) / n,
                    (found.counts() < 50).astype(float),
                ],
                axis=1,
            )
        )
    return np.concatenate(rows) if rows else np.zeros((0, N_FEATURES))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Strength = weights . (features - centre) / scale; score = logistic around a threshold."""

    def __init__(self, centre, scale, weights, threshold, slope):
        self.centre, self.scale, self.weights = centre, scale, weights
        self.threshold, self.slope = threshold, slope

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -6, 6) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        offset = np.log(AT_THRESHOLD / (1 - AT_THRESHOLD))
        return sigmoid(self.slope * (self.strength(x) - self.threshold) + offset)


def train(x: np.ndarray, y: np.ndarray, bad_share: float) -> Model:
    """Fit on features and labels; ``bad_share`` is the share of label 0 among all rows."""
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0, 1.0)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.clip((x - centre) / scale, -6, 6)
    rng = np.random.default_rng(5)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    difference = z[rng.choice(good, PAIRS)] - z[rng.choice(bad, PAIRS)]
    w, square = np.zeros(N_FEATURES), np.full(N_FEATURES, 1e-8)
    for _ in range(STEPS):
        gradient = -(difference * (1 - sigmoid(difference @ w))[:, None]).mean(axis=0) + RIDGE * w
        square += gradient**2
        w -= RATE * gradient / np.sqrt(square)
    model = Model(centre, scale, w, 0.0, 1.0)
    strength = model.strength(x)
    # Each class counts as much as it does among all labelled rows.
    share = np.where(y == 0, bad_share / len(bad), (1 - bad_share) / len(good))
    order = np.argsort(strength, kind="stable")
    model.threshold = float(strength[order][min(np.searchsorted(np.cumsum(share[order]), bad_share), len(y) - 1)])
    offset = np.log(AT_THRESHOLD / (1 - AT_THRESHOLD))

    def loss(slope):
        p = np.clip(sigmoid(slope * (strength - model.threshold) + offset), 1e-9, 1 - 1e-9)
        return -(share * np.where(y == 1, np.log(p), np.log(1 - p))).sum()

    model.slope = float(min(np.geomspace(0.05, 20, 40), key=loss))
    return model


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """Weights from a bounded sample of texts, class shares from all labels outside the fold."""
    shares = (
        labels.filter(~labelled.held_out() & F.col("quality").isin(0, 1))
        .agg(F.avg(1 - F.col("quality")).alias("bad"))
        .first()
    )
    rows = labelled.labelled_texts(docs, labelled.training_rows(labels, "quality", ROWS_PER_CLASS))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(found.tolist(), pa.list_(pa.float64()))],
                names=["doc_id", "label", "x"],
            )

    found = sorted(
        rows.select("doc_id", "text", "label")
        .mapInArrow(measure, "doc_id long, label int, x array<double>")
        .collect()
    )
    x = np.array([r.x for r in found]).reshape(-1, N_FEATURES)
    return train(x, np.array([r.label for r in found], dtype=np.int64), float(shares.bad or 0.0))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted for every row; no row leaves its task."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for lo in range(0, len(column), 500):
                part = column.slice(lo, 500)
                x = features(part)
                score = np.where(x[:, 7] > 0, shared.value.score(x), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, 500), pa.array(score)], names=["doc_id", "score"]
                )

    return (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
        )
        .mapInArrow(run, "doc_id long, score double")
        .select(
            "doc_id",
            F.coalesce(labelled.held_out(), F.lit(False)).alias("held_out"),
            "score",
            (F.col("score") >= AT_THRESHOLD).cast("int").alias("predicted"),
        )
    )
