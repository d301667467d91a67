"""The sentiment record: label, scores, defaults and shape repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.schemas import SENTIMENT_ANALYSIS, SENTIMENT_LABELS


def argmax_label(scores: Column, labels: tuple[str, ...] = SENTIMENT_LABELS) -> Column:
    """Label of the highest score; the first label wins a tie, an index past the labels
    is ``unknown``."""
    names = F.array(*[F.lit(x) for x in labels])
    position = F.array_position(scores, F.array_max(scores)).cast("int")
    return F.coalesce(F.get(names, position - 1), F.lit("unknown"))


def softmax(logits: Column) -> Column:
    """Softmax of a score array, shifted by its maximum."""
    shifted = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x)
    return F.transform(shifted, lambda x: x / total)


def score_map(scores: Column, labels: tuple[str, ...] = SENTIMENT_LABELS) -> Column:
    names = F.array(*[F.lit(x) for x in labels])
    return F.map_from_arrays(names, scores)


def one_hot(label: Column) -> Column:
    """Scores of 1.0 on the label and 0.0 elsewhere; NULL for a missing label."""
    ones = F.array(*[F.when(label == x, 1.0).otherwise(0.0) for x in SENTIMENT_LABELS])
    return F.when(label.isNotNull(), ones)


def analysis(scores: Column, error: Column | None = None) -> Column:
    """Nested analysis record from a score array in label order; NULL scores stay NULL."""
    record = F.struct(
        F.struct(argmax_label(scores).alias("sentiment"), score_map(scores).alias("scores")).alias(
            "overall_sentiment"
        ),
        (error if error is not None else F.lit(None).cast("string")).alias("error"),
    )
    return F.when(scores.isNotNull(), record).cast(SENTIMENT_ANALYSIS)


def neutral_default(error: Column) -> Column:
    """What a failed or impossible analysis stores: neutral, with the reason."""
    return analysis(F.array(F.lit(0.0), F.lit(1.0), F.lit(0.0)), error)


def label_of(record: str = "sentiment_analysis") -> Column:
    return F.col(f"{record}.overall_sentiment.sentiment")


def nested_form(flat_label: Column, flat_scores: Column, nested: Column) -> Column:
    """Canonical nested record, whichever of the two written shapes a row carries."""
    flat = F.when(
        flat_label.isNotNull(),
        F.struct(
            F.struct(flat_label.alias("sentiment"), flat_scores.alias("scores")).alias("overall_sentiment"),
            F.lit(None).cast("string").alias("error"),
        ),
    )
    return F.coalesce(nested.cast(SENTIMENT_ANALYSIS), flat.cast(SENTIMENT_ANALYSIS))


def label_counts(label: Column) -> list[Column]:
    """One zero-filled count per label; missing and unknown labels are not counted."""
    return [F.count_if(label == x).alias(x) for x in SENTIMENT_LABELS]
