"""Data-health checks over tables, topics and runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import times as TM

# Severities in rising order, and the freshness limit.
SEVERITIES = ("success", "warning", "error")
FRESHNESS_HOURS = 24


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def missing(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Expected keys that do not occur."""
    return expected.select(key).join(present.select(key).distinct(), key, "left_anti")


def expected_names(df: DataFrame, listing: str, name: str) -> DataFrame:
    """Names of a comma-separated setting, trimmed, blanks dropped."""
    parts = F.filter(F.transform(F.split(F.lit(listing), ","), lambda p: F.trim(p)), lambda p: p != "")
    one = df.sparkSession.range(1)
    return one.select(F.explode(parts).alias(name))


def latest_runs(runs: DataFrame, limit: int = 5) -> DataFrame:
    return runs.orderBy(F.desc("ts"), F.desc("run_id")).limit(limit)


def freshness(runs: DataFrame, as_of, hours: int = FRESHNESS_HOURS) -> DataFrame:
    """Status of the latest run: failed is an error, too old or none at all a warning."""
    latest = runs.agg(F.max(F.struct("ts", "run_id", "status")).alias("last"))
    old = TM.moment(as_of) - F.col("last.ts") > F.expr(f"INTERVAL '{hours}' HOUR")
    status = (
        F.when(F.col("last").isNull(), "warning")
        .when(F.col("last.status") == "failed", "error")
        .when(old, "warning")
        .otherwise("success")
    )
    return latest.select(F.col("last.ts").alias("last_ts"), F.col("last.status").alias("last_status"), status.alias("status"))


def status_when_missing(missing_rows: DataFrame, part: str) -> DataFrame:
    """A warning when anything is missing."""
    return missing_rows.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(part).alias("part"), F.when(F.col("n") > 0, "warning").otherwise("success").alias("status")
    )


def overall(parts: DataFrame) -> DataFrame:
    """The worst status of all parts."""
    names = F.array(*[F.lit(s) for s in SEVERITIES])
    worst = F.max(F.array_position(names, F.col("status"))).cast("int")
    return parts.agg(F.get(names, worst - 1).alias("overall_status"), F.count(F.lit(1)).alias("parts"))


def article_cards(df: DataFrame, preview: int = 300) -> DataFrame:
    """Display fields of an article: head data, label and a content preview."""
    return df.select(
        "url",
        "title",
        "press",
        "category",
        TM.iso(F.col("published_at")).alias("published_at"),
        F.col("sentiment_analysis.overall_sentiment.sentiment").alias("sentiment"),
        _score("positive"),
        _score("neutral"),
        _score("negative"),
        F.concat(F.substring("content", 1, preview), F.lit("...")).alias("preview"),
    )


def _score(label: str) -> Column:
    scores = F.col("sentiment_analysis.overall_sentiment.scores")
    return F.try_element_at(scores, F.lit(label)).alias(f"score_{label}")
