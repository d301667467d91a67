"""Counts over time, categories, sentiment and topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.functions import times as TM
from broadsheet.functions import topics as TP
from broadsheet.schemas import CATEGORIES, SENTIMENT_LABELS


def recent(df: DataFrame, as_of, days: int, category: str | None = None, at: str = "published_at") -> DataFrame:
    df = df.where(TM.since(F.col(at), as_of, days))
    return df.where(F.col("category") == category) if category else df


def sentiment_distribution(df: DataFrame, as_of, category: str | None = None, days: int = 7) -> DataFrame:
    """One row with a zero-filled count per label."""
    return recent(df, as_of, days, category).agg(*S.label_counts(S.label_of()))


def distribution_rows(distribution: DataFrame) -> DataFrame:
    """Label and count as rows."""
    return distribution.unpivot([], list(SENTIMENT_LABELS), "label", "count")


def timeline(
    df: DataFrame, as_of, interval: str = "day", days: int = 30, category: str | None = None, sentiment: str | None = None
) -> DataFrame:
    """Articles per time bucket; empty buckets are absent."""
    rows = recent(df, as_of, days, category)
    if sentiment:
        rows = rows.where(S.label_of() == sentiment)
    return (
        rows.groupBy(TM.bucket(F.col("published_at"), interval).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.coalesce(F.col("bucket"), F.lit("")) != "")
        .orderBy("bucket")
    )


def sentiment_points(df: DataFrame, as_of, interval: str = "day", days: int = 30, category: str | None = None) -> DataFrame:
    """Zero-filled label counts and their total per time bucket, in one aggregation."""
    rows = recent(df, as_of, days, category).where(S.label_of().isNotNull())
    return (
        rows.groupBy(TM.bucket(F.col("published_at"), interval).alias("bucket"))
        .agg(*S.label_counts(S.label_of()), F.count(F.lit(1)).alias("total"))
        .where(F.coalesce(F.col("bucket"), F.lit("")) != "")
        .orderBy("bucket")
    )


def sentiment_trends(df: DataFrame, as_of, interval: str = "day", days: int = 30, category: str | None = None) -> DataFrame:
    return sentiment_points(df, as_of, interval, days, category).drop("total")


def sentiment_trend_map(df: DataFrame, as_of, interval: str = "day", days: int = 30) -> DataFrame:
    """Per bucket a map from each label that occurs to its count."""
    rows = recent(df, as_of, days).where(S.label_of().isNotNull())
    pairs = rows.groupBy(
        TM.bucket(F.col("published_at"), interval).alias("bucket"), S.label_of().alias("label")
    ).agg(F.count(F.lit(1)).alias("count"))
    # At most one entry per label and bucket is collected here.
    return pairs.groupBy("bucket").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "count")))).alias("counts")
    )


def time_range(as_of, days: int) -> dict[str, Column]:
    """Both ends of the window a summary covers."""
    return {"start": TM.moment(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"), "end": TM.moment(as_of)}


def category_summary(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Article count and label counts of every known category that has articles."""
    return (
        recent(df, as_of, days)
        .where(TP.is_known_category(F.col("category")))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("article_count"), *S.label_counts(S.label_of()))
        .withColumns(time_range(as_of, days))
    )


def stats_summary(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The total over all categories (``category`` NULL) and one row per known category.

    Rows are counted once per category; the grouping sets then run on those few rows.
    """
    per_category = (
        recent(df, as_of, days)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("article_count"), *S.label_counts(S.label_of()))
    )
    sums = [F.sum(c).alias(c) for c in ("article_count", *SENTIMENT_LABELS)]
    both = per_category.groupingSets([["category"], []], "category").agg(
        F.grouping("category").alias("is_total"), *sums
    )
    known = both.where((F.col("is_total") == 1) | TP.is_known_category(F.col("category")))
    return known.withColumns(time_range(as_of, days))


def top_topics(df: DataFrame, as_of, days: int = 7, limit: int = 5) -> DataFrame:
    """Most frequent topics of every category with the topic's words.

    Rows are counted per distinct word list first, in a hash aggregation over numbers;
    where records disagree on the words, the smallest list is shown, so the answer does
    not depend on row order.
    """
    exploded = recent(df, as_of, days).select("category", "topic_keywords", F.explode("main_topics").alias("topic"))
    words = F.try_element_at("topic_keywords", F.col("topic").cast("string"))
    counted = exploded.groupBy("category", "topic", words.alias("words")).agg(F.count(F.lit(1)).alias("count"))
    topics = counted.groupBy("category", "topic").agg(F.sum("count").alias("count"), F.min("words").alias("words"))
    window = Window.partitionBy("category").orderBy(F.desc("count"), F.asc("topic"))
    return (
        topics.withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= limit)
        .select(
            "category",
            "topic",
            "count",
            F.coalesce("words", F.array().cast("array<string>")).alias("keywords"),
            "rank",
        )
    )


def with_top_topics(summary: DataFrame, df: DataFrame, as_of, days: int = 7, limit: int = 5) -> DataFrame:
    """Add ``top_topics`` to a summary per category: records of topic, count and keywords, best first.

    At most ``limit`` rows per category are collected; a total over all categories (category NULL)
    and a category without topics have an empty list.
    """
    top = top_topics(df, as_of, days, limit)
    record = F.struct("rank", F.struct("topic", "count", "keywords").alias("topic"))
    lists = top.groupBy("category").agg(
        F.transform(F.array_sort(F.collect_list(record)), lambda t: t["topic"]).alias("top_topics")
    )
    joined = summary.join(lists, "category", "left")
    kind = dict(lists.dtypes)["top_topics"]
    return joined.withColumn("top_topics", F.coalesce("top_topics", F.array().cast(kind)))


def topic_sentiment(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Article count and label counts of every topic."""
    exploded = recent(df, as_of, days).withColumn("topic_id", F.explode("main_topics"))
    return exploded.groupBy("topic_id").agg(
        F.count(F.lit(1)).alias("article_count"), *S.label_counts(S.label_of())
    )


def topic_labels(topics: DataFrame) -> DataFrame:
    """Display rows of topics: name, first five and first ten words."""
    return topics.select(
        "category",
        F.concat(F.lit("Topic "), F.col("topic").cast("string")).alias("label"),
        "count",
        F.array_join(F.slice("keywords", 1, 5), ", ").alias("short_words"),
        F.array_join(F.slice("keywords", 1, 10), ", ").alias("words"),
    )


def category_list(df: DataFrame) -> DataFrame:
    """Known categories in declared order with their article counts, empty ones too."""
    counts = df.groupBy("category").agg(F.count(F.lit(1)).alias("article_count"))
    names = df.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate(CATEGORIES)], "position int, category string"
    )
    return names.join(counts, "category", "left").fillna(0, ["article_count"])


def topic_catalog(messages: DataFrame, stages: tuple[str, ...]) -> DataFrame:
    """Every declared topic with display name and the messages it holds.

    Stages are exploded from an array on the seven-row dimension.
    """
    spark = messages.sparkSession
    declared = spark.createDataFrame([(c,) for c in CATEGORIES], "category string").withColumn(
        "stage", F.explode(F.array(*[F.lit(s) for s in stages]))
    )
    held = messages.groupBy("topic").agg(F.count(F.lit(1)).alias("message_count"))
    named = declared.withColumns(
        {"topic": TP.topic_name(F.col("category"), F.col("stage")), "display_name": TP.display_name(F.col("category"))}
    )
    return named.join(held, "topic", "left").fillna(0, ["message_count"])


def job_stats(df: DataFrame, seconds: Column, *groups: str) -> DataFrame:
    """Items, total seconds and mean seconds per item."""
    total = F.sum(seconds)
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("items"),
        F.round(total, 4).alias("total_seconds"),
        F.round(F.try_divide(total, F.count(F.lit(1))), 4).alias("mean_seconds"),
    )
