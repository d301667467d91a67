"""Routing and archiving of messages and articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import topics as TP
from broadsheet.sources.tables import section_dimension, source_number


def route_by_category(df: DataFrame, stage: str) -> DataFrame:
    """Target topic from the record's own category."""
    return df.withColumn("topic", TP.topic_name(F.col("category"), stage))


def route_by_topic(df: DataFrame, source_stage: str, stage: str, known_only: bool = False) -> DataFrame:
    """Target topic from the category named by the input topic."""
    category = TP.category_between(F.col("topic"), source_stage) if known_only else TP.topic_part(F.col("topic"), 1)
    routed = df.withColumn("target_topic", TP.topic_name(category, stage))
    return routed.where(TP.is_known_category(category)) if known_only else routed


def dispatch(df: DataFrame) -> DataFrame:
    """Sink messages with the table they go to; other topics are left out."""
    return df.withColumn("table_name", TP.target_table(F.col("topic"))).where(F.col("table_name").isNotNull())


def archive(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Write messages as JSON under one folder per category of the topic.

    Each task writes the categories it sees, so a category holding most messages is
    spread over all tasks; ``rows_per_file`` bounds a file.
    """
    (
        df.withColumn("category", TP.topic_part(F.col("topic"), 1))
        .write.mode("append")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("category")
        .json(path)
    )


def archive_stats(df: DataFrame, failed: Column) -> DataFrame:
    """Messages, stored and failed per category of the topic."""
    return df.groupBy(TP.topic_part(F.col("topic"), 1).alias("category")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(~failed).alias("stored"),
        F.count_if(failed).alias("failed"),
    )


def with_section(articles: DataFrame) -> DataFrame:
    """Site and section category by the fixed section table (twenty rows)."""
    sections = section_dimension(articles.sparkSession).withColumnRenamed("category", "section_category")
    return articles.withColumn("position", source_number("press")).join(F.broadcast(sections), "position")
