"""Trained models: the sentiment classifier and the topic model (MLlib)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer, HashingTF, IDF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.functions import text as X
from broadsheet.operators import enrich
from broadsheet.schemas import SENTIMENT_LABELS
from broadsheet.session import file_system

#: Scores a list of units (texts, or lists of word codes): one list per unit, in label order.
Scorer = Callable[[list], "np.ndarray | list[list[float]]"]


def word_codes(text: Column, tokenizer: X.Tokenizer = X.letter_tokens) -> Column:
    """Words as Spark's 32-bit hashes; hashing them again gives the feature (see ``train_sentiment``)."""
    return F.transform(tokenizer(text), lambda word: F.hash(word))


def train_sentiment(
    labelled: DataFrame, features: int = 1 << 14, max_iter: int = 20, tokenizer: X.Tokenizer = X.letter_tokens
) -> PipelineModel:
    """Multinomial logistic regression over hashed word counts.

    Hashing keeps the model at ``3 * features`` numbers however many words the corpus
    has; no vocabulary is collected. ``HashingTF`` hashes an integer as ``F.hash`` does, so
    scoring finds the same feature without a vector column.
    """
    position = F.array_position(F.array(*[F.lit(x) for x in SENTIMENT_LABELS]), F.col("sentiment")) - 1
    rows = labelled.where(F.col("sentiment").isin(*SENTIMENT_LABELS)).select(
        word_codes(F.col("content"), tokenizer).alias("codes"), position.cast("double").alias("label")
    )
    stages = [
        HashingTF(inputCol="codes", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="tfidf"),
        LogisticRegression(
            featuresCol="tfidf",
            labelCol="label",
            family="multinomial",
            maxIter=max_iter,
            regParam=0.01,
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def publish(model: PipelineModel, folder: str) -> str:
    """Store a fitted model as the next version of a folder; a version counts once it is whole."""
    spark = SparkSession.active()
    versions = published(spark, folder)
    path = f"{folder}/version={(versions or [0])[-1] + 1}"
    model.write().overwrite().save(path)
    fs, done = file_system(spark, f"{path}/_PUBLISHED")
    fs.create(done).close()
    return path


def published(spark: SparkSession, folder: str) -> list[int]:
    fs, path = file_system(spark, folder)
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path)]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(p.suffix("/_PUBLISHED")))


def latest(spark: SparkSession, folder: str) -> PipelineModel:
    """The newest whole version. A job loads it when it starts, so a restart takes a new one up."""
    versions = published(spark, folder)
    if not versions:
        raise ValueError(f"no model in {folder}")
    return PipelineModel.load(f"{folder}/version={versions[-1]}")


def linear_scorer(model: PipelineModel) -> tuple[Callable[[], Scorer], int]:
    """The trained pipeline as plain weights (3 numbers a feature), and the number of features.

    Units are lists of feature numbers. A class never seen in training scores 0.
    """
    hashing, idf, regression = model.stages
    weights = regression.coefficientMatrix.toArray() * idf.idf.toArray()
    bias = regression.interceptVector.toArray()

    def score(units: list) -> np.ndarray:
        out = np.zeros((len(units), len(SENTIMENT_LABELS)))
        for row, features in zip(out, units, strict=True):
            logits = weights[:, np.asarray(features, np.int64)].sum(axis=1) + bias
            powers = np.exp(logits - logits.max())
            row[: len(bias)] = powers / powers.sum()
        return out

    return lambda: score, hashing.getNumFeatures()


def unit_scores(units: Column, load: Callable[[], Scorer], unit_type: str = "string") -> Column:
    """Scores of an array of units, within the row: a record of ``scores`` and ``error``.

    ``load`` is called once per task and returns the scorer, so an external model is loaded
    there. A scorer that fails on a row, or returns other than one finite score per unit and
    label, gives that row no scores and the reason. A null or empty array gives neither.
    """

    held: list[Scorer] = []

    def score_row(row: list | None) -> tuple:
        if not held:
            held.append(load())
        if not row:
            return None, None
        try:
            table = np.asarray(held[0](row), float)
            if table.shape != (len(row), len(SENTIMENT_LABELS)) or not np.isfinite(table).all():
                raise ValueError("not one finite score per unit and label")
            return table.tolist(), None
        except Exception as problem:  # whatever an external model raises
            return None, f"{type(problem).__name__}: {problem}"

    # Plain rows: an Arrow batch of 10,000 rows, each with its list of units, fills a worker.
    return F.udf(score_row, "scores array<array<double>>, error string", useArrow=False)(units.cast(f"array<{unit_type}>"))


def feature_units(units: Column, features: int, tokenizer: X.Tokenizer = X.letter_tokens) -> Column:
    """Array of texts to array of arrays of feature numbers."""
    return F.transform(
        units, lambda text: F.transform(word_codes(text, tokenizer), lambda code: F.pmod(F.hash(code), F.lit(features)))
    )


def chunk_units() -> Column:
    """The chunks of ``content``; NULL where it is missing, so that no model sees a NULL text."""
    return F.when(F.col("content").isNotNull(), X.chunks_of(F.col("content")))


def mean_scores(scores: Column) -> Column:
    """Mean over the units per label; NULL without units."""
    sums = [
        F.aggregate(F.transform(scores, lambda one: F.get(one, F.lit(i))), F.lit(0.0), lambda total, x: total + x)
        for i in range(len(SENTIMENT_LABELS))
    ]
    return F.when(F.size(scores) > 0, F.array(*[total / F.size(scores) for total in sums]))


def with_scores(df: DataFrame, units: Column, load: Callable[[], Scorer], unit_type: str = "string") -> DataFrame:
    """Add ``_scored`` (``unit_scores``). The units are a column of their own before they go to Python."""
    once = X.compute_once(df, "_units", units)
    return once.withColumn("_scored", unit_scores(F.col("_units"), load, unit_type)).drop("_units")


def sentiment_in_row(
    df: DataFrame, units: Column, load: Callable[[], Scorer], as_of, unit_type: str = "string"
) -> DataFrame:
    """Attach the mean of the units' scores; errors become neutral with the reason."""
    once = with_scores(df, units, load, unit_type)
    reason = F.coalesce(enrich.missing_content(F.col("content")), F.col("_scored.error"))
    return enrich.attach_sentiment(once, mean_scores(F.col("_scored.scores")), reason, as_of).drop("_scored")


def analyse_sentiment(df: DataFrame, model: PipelineModel, as_of, tokenizer: X.Tokenizer = X.letter_tokens) -> DataFrame:
    """Score the chunks of every text with the trained model, average them, attach the record.

    All of it stays in the row: no shuffle, one reading of the text, the same in a stream,
    and two versions of one article keep their own scores.
    """
    load, features = linear_scorer(model)
    units = feature_units(chunk_units(), features, tokenizer)
    return sentiment_in_row(df, units, load, as_of, "array<int>")


def analyse_sentiment_with(df: DataFrame, load: Callable[[], Scorer], as_of) -> DataFrame:
    """The same with an external model that scores chunk texts."""
    return sentiment_in_row(df, chunk_units(), load, as_of)


def sentiment_words(
    df: DataFrame,
    model: PipelineModel,
    threshold: float = 0.6,
    top_n: int = 30,
    tokenizer: X.Tokenizer | None = None,
) -> DataFrame:
    """Add one array per label: the frequent words of the text that the classifier is sure of.

    Words are scored one by one within the row; a text without words has empty arrays. The
    most frequent word comes first.
    """
    load, features = linear_scorer(model)
    once = X.compute_once(df, "_words", X.keywords_of(F.col("content"), top_n, tokenizer=tokenizer))
    units = feature_units(F.col("_words"), features, tokenizer or X.letter_tokens)
    scored = with_scores(once, units, load, "array<int>")
    pairs = F.zip_with(
        "_words", "_scored.scores", lambda word, scores: F.struct(word.alias("word"), scores.alias("scores"))
    )

    def sure(label: str) -> Column:
        kept = F.filter(
            pairs,
            lambda p: (F.array_max(p["scores"]) > threshold) & (S.argmax_label(p["scores"]) == label),
        )
        return F.coalesce(F.transform(kept, lambda p: p["word"]), F.array().cast("array<string>"))

    return scored.withColumns({label: sure(label) for label in SENTIMENT_LABELS}).drop("_words", "_scored")


def topic_model(
    df: DataFrame, k: int = 5, seed: int = 7, least_share: float = 0.0005, max_iter: int = 10, words: int = 10
) -> DataFrame:
    """LDA over keywords: adds ``topic_analysis`` to every row.

    Every row takes part in every iteration. The vocabulary is all terms found in at least
    ``least_share`` of the rows; with n keywords a row these are at most n / ``least_share``,
    whatever the corpus. The result still depends on the order of terms with equal counts and
    on the layout of the rows. The topic words (``k * words`` strings) become
    one literal map.
    """
    counts = CountVectorizer(inputCol="keywords", outputCol="_counts", minDF=least_share).fit(df)
    vectors = counts.transform(df)
    lda = LDA(
        featuresCol="_counts",
        topicDistributionCol="_topics",
        k=k,
        seed=seed,
        maxIter=max_iter,
        optimizer="online",
        subsamplingRate=1.0,
    )
    model = lda.fit(vectors)
    pairs = []
    for row in model.describeTopics(words).toLocalIterator():
        pairs += [F.lit(str(row.topic)), F.array(*[F.lit(counts.vocabulary[i]) for i in row.termIndices])]
    distribution = vector_to_array("_topics")
    above = F.filter(
        F.transform(distribution, lambda p, i: F.struct((-p).alias("neg"), i.alias("topic"))),
        lambda t: -t["neg"] > 1.0 / k,
    )
    main = F.transform(F.sort_array(above), lambda t: t["topic"])
    analysed = model.transform(vectors).withColumn(
        "topic_analysis",
        F.struct(
            distribution.alias("topic_distribution"),
            main.alias("main_topics"),
            F.create_map(*pairs).alias("topic_keywords"),
        ),
    )
    return analysed.drop("_counts", "_topics")
