"""Toxicity from subword-bag embeddings averaged into a linear softmax.

A word's vector is the average of the embeddings of its character n-grams (3 to 6 characters
with word-end marks, and the word itself), looked up by hash in ``BUCKETS`` rows, so a
misspelling or an ending never seen shares most of its vector with the words it resembles. A
passage of ``PASSAGE`` words is the average of its words' vectors; a linear softmax over it
gives the two classes. Embeddings and softmax are trained together in numpy with Adagrad.

A text is as toxic as its most toxic passage, whatever its length: in training each labelled
text is represented by its presently highest passage (at first by random ones), in scoring all
passages of the whole text count. As the softmax is linear, a passage's score is the mean of
its words' scores, so each different word is scored once per task.

Texts without words (null, empty, signs only) have score 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import labelled, words

BUCKETS = 1 << 17
WIDTH = 8
GRAMS = (3, 4, 5, 6)
PASSAGE = 4
#: Bounds of the training sample: rows per class, and characters of a text taken as training row.
ROWS_PER_CLASS = 2500
LONGEST_TRAINING_TEXT = 20_000
WARM_EPOCHS = 12
EPOCHS = 50
RATE = 0.5
KEPT_WORDS = 250_000
#: Words whose n-grams are made at once.
PART = 20_000
WORD = re.compile(r"[^\W_]+")


def split(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams(chosen: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, bucket) for every n-gram of every word."""
    marked = [f"<{w}>" for w in chosen]
    points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.array([len(m) for m in marked])
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(chosen)), lengths)
    stop = ends[owner]
    place = np.arange(len(points))
    who, what = [], []
    for n in GRAMS:
        at = place[place + n <= stop]
        who.append(owner[at])
        what.append(words.fold(points, at, n))
    whole = np.add.reduceat(
        (points + np.uint64(1)) * words.mix((place - (ends - lengths)[owner]).astype(np.uint64) + np.uint64(99)),
        ends - lengths,
    )
    who.append(np.arange(len(chosen)))
    what.append(words.mix(whole))
    return np.concatenate(who), (np.concatenate(what) >> np.uint64(64 - 17)).astype(np.int64)


def grams_by_word(chosen: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, word after word, and how many each word has."""
    buckets, counts = [], []
    for lo in range(0, len(chosen), PART):
        part = chosen[lo : lo + PART]
        who, what = grams(part)
        buckets.append(what[np.argsort(who, kind="stable")].astype(np.int32))
        counts.append(np.bincount(who, minlength=len(part)))
    return np.concatenate(buckets), np.concatenate(counts)


def word_scores(table: np.ndarray, chosen: list[str]) -> np.ndarray:
    who, what = grams(chosen)
    total = np.bincount(who, weights=table[what], minlength=len(chosen))
    return total / np.bincount(who, minlength=len(chosen))


def passages(scores: np.ndarray) -> np.ndarray:
    """Mean score of each run of PASSAGE words (of all words where there are fewer)."""
    size = min(PASSAGE, len(scores))
    total = np.concatenate([[0.0], np.cumsum(scores)])
    return (total[size:] - total[:-size]) / size


class Model:
    """Score per bucket (embedding times the difference of the softmax rows) and the bias."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias

    def of_texts(self, texts: list[list[str]], known: dict[str, float]) -> np.ndarray:
        if len(known) > KEPT_WORDS:
            known.clear()
        new = list({w for text in texts for w in text if w not in known})
        for lo in range(0, len(new), PART):
            part = new[lo : lo + PART]
            known.update(zip(part, word_scores(self.table, part).tolist(), strict=True))
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            if text:
                scores = np.fromiter(map(known.__getitem__, text), np.float64, len(text))
                out[i] = 1 / (1 + np.exp(-np.clip(passages(scores).max() + self.bias, -40, 40)))
        return out


def train(texts: list[str], labels: np.ndarray) -> Model:
    # One text's words are held at a time, and n-grams are made for a part of the words at a time:
    # all words of the sample as strings would take several times the room of the sample.
    ids: dict[str, int] = {}
    coded, usable = [], []
    for i, text in enumerate(texts):
        if found := split(text):
            coded.append(np.array([ids.setdefault(w, len(ids)) for w in found], np.int32))
            usable.append(i)
    labels = np.asarray(labels)[usable].astype(np.int64)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS, np.float64), -40.0)
    what, counts = grams_by_word(list(ids))
    del ids
    firsts = np.cumsum(counts) - counts
    rng = np.random.default_rng(7)
    emb = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    soft, bias = rng.normal(0, 0.1, (WIDTH, 2)), np.zeros(2)
    emb_sq, soft_sq, bias_sq = np.full(emb.shape, 1e-6), np.full(soft.shape, 1e-6), np.full(2, 1e-6)
    weight = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean()) / len(labels)
    for epoch in range(EPOCHS):
        if epoch >= WARM_EPOCHS:
            diff = emb @ (soft[:, 1] - soft[:, 0])
            scores = np.add.reduceat(diff[what], firsts) / counts
        rows, owner = [], []
        for i, code in enumerate(coded):
            picks = (
                [int(passages(scores[code]).argmax())]
                if epoch >= WARM_EPOCHS
                else rng.integers(0, max(len(code) - PASSAGE, 0) + 1, 3)
            )
            for pick in picks:
                rows.append(code[pick : pick + PASSAGE])
                owner.append(i)
        owner = np.array(owner)
        size = np.array([len(r) for r in rows])
        taken = np.concatenate(rows)
        row = np.repeat(np.arange(len(rows)), size)
        # n-grams of the words taken, and their part in the average of their passage
        n = counts[taken]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        bucket = what[np.repeat(firsts[taken], n) + inner]
        part = np.repeat(1 / (n * size[row]), n)
        gram_row = np.repeat(row, n)
        vectors = np.stack(
            [np.bincount(gram_row, part * emb[bucket, k], len(rows)) for k in range(WIDTH)], axis=1
        )
        logits = vectors @ soft + bias
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        error = chance.copy()
        error[np.arange(len(rows)), labels[owner]] -= 1
        error *= (weight[owner] * len(coded) / len(rows))[:, None]
        back = error @ soft.T
        soft_grad, bias_grad = vectors.T @ error, error.sum(axis=0)
        for k in range(WIDTH):
            grad = np.bincount(bucket, part * back[gram_row, k], BUCKETS)
            emb_sq[:, k] += grad * grad
            emb[:, k] -= RATE * grad / np.sqrt(emb_sq[:, k])
        soft_sq += soft_grad**2
        soft -= RATE * 0.2 * soft_grad / np.sqrt(soft_sq)
        bias_sq += bias_grad**2
        bias -= RATE * 0.2 * bias_grad / np.sqrt(bias_sq)
    return Model(emb @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]))


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    rows = labelled.training_rows(labels, "toxic", ROWS_PER_CLASS)
    chosen = labelled.labelled_texts(docs, rows).filter(
        F.length("text").between(1, LONGEST_TRAINING_TEXT)
    )
    found = sorted(chosen.select("doc_id", "text", "label").collect())
    return train([r.text for r in found], np.array([r.label for r in found], dtype=np.int64))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted for every row; no row leaves its task."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text")
            for lo in range(0, len(keys), 200):
                part = [split(t.as_py()) for t in texts.slice(lo, 200)]
                score = shared.value.of_texts(part, known)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(lo, 200), pa.array(score)], names=["doc_id", "score"]
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
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
        )
    )
