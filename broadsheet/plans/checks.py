"""Data-health queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.operators import health
from broadsheet.plans import sqlparts as Q
from broadsheet.plans.registry import query
from broadsheet.schemas import CATEGORIES
from broadsheet.sources import tables as TB

NOW = TB.AS_OF
TABLES = ("documents", "labels", "events", "pages", "conversations")
EXPECTED_CATEGORIES = ",".join(CATEGORIES) + ", sports ,, weather"
EXPECTED_TOPICS = "news.economy.raw, news.it.summary,,news.weather.raw , news.sports.archive"
ERRORS_ALLOWED = 50

RUNS_SQL = f"""runs AS (
  SELECT strftime(ts, '%Y%m%d') AS run_id, max(ts) AS ts,
    CASE WHEN count(*) FILTER (event_type = 'error') > {ERRORS_ALLOWED} THEN 'failed' ELSE 'success' END AS status
  FROM events GROUP BY 1)"""
FRESHNESS_SQL = f"""fresh AS (
  SELECT ts AS last_ts, status AS last_status, CASE WHEN status = 'failed' THEN 'error'
    WHEN {Q.NOW} - ts > INTERVAL 24 HOUR THEN 'warning' ELSE 'success' END AS status
  FROM runs ORDER BY ts DESC LIMIT 1)"""


def runs(spark, sf_dir):
    """One run per day of the events; it failed when the day saw too many errors."""
    return (
        TB.table(spark, sf_dir, "events")
        .groupBy(F.date_format("ts", "yyyyMMdd").alias("run_id"))
        .agg(F.max("ts").alias("ts"), F.count_if(F.col("event_type") == "error").alias("errors"))
        .select("run_id", "ts", F.when(F.col("errors") > ERRORS_ALLOWED, "failed").otherwise("success").alias("status"))
    )


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
)
def table_counts(spark, sf_dir):
    return health.table_counts({t: TB.table(spark, sf_dir, t) for t in TABLES})


def missing_categories(spark, sf_dir):
    articles = TB.articles(spark, sf_dir).select("category")
    expected = health.expected_names(articles, EXPECTED_CATEGORIES, "category")
    return health.missing(expected, articles, "category")


@query(
    "missing_partitions",
    f"""WITH {Q.ARTICLES} SELECT trim(x) AS category FROM (SELECT unnest(string_split('{EXPECTED_CATEGORIES}', ',')) AS x)
    WHERE trim(x) <> '' AND trim(x) NOT IN (SELECT category FROM articles)""",
)
def missing_partitions(spark, sf_dir):
    return missing_categories(spark, sf_dir)


def topics_missing(spark, sf_dir):
    messages = TB.messages(spark, sf_dir).select("topic")
    return health.missing(health.expected_names(messages, EXPECTED_TOPICS, "topic"), messages, "topic")


@query(
    "missing_topics",
    f"""WITH {Q.MESSAGES} SELECT trim(x) AS topic FROM (SELECT unnest(string_split('{EXPECTED_TOPICS}', ',')) AS x)
    WHERE trim(x) <> '' AND trim(x) NOT IN (SELECT topic FROM messages)""",
)
def missing_topics(spark, sf_dir):
    return topics_missing(spark, sf_dir)


@query("latest_runs", f"WITH {RUNS_SQL} SELECT run_id, ts, status FROM runs ORDER BY ts DESC, run_id DESC LIMIT 5")
def latest_runs(spark, sf_dir):
    return health.latest_runs(runs(spark, sf_dir))


@query("freshness_check", f"WITH {RUNS_SQL}, {FRESHNESS_SQL} SELECT * FROM fresh")
def freshness_check(spark, sf_dir):
    return health.freshness(runs(spark, sf_dir), NOW)


@query(
    "health_report",
    f"""WITH {RUNS_SQL}, {FRESHNESS_SQL}
    SELECT CASE WHEN (SELECT status FROM fresh) = 'error' THEN 'error' ELSE 'warning' END AS overall_status, 3 AS parts""",
)
def health_report(spark, sf_dir):
    parts = [
        health.status_when_missing(missing_categories(spark, sf_dir), "tables"),
        health.status_when_missing(topics_missing(spark, sf_dir), "topics"),
        health.freshness(runs(spark, sf_dir), NOW).select(F.lit("runs").alias("part"), "status"),
    ]
    return health.overall(parts[0].unionByName(parts[1]).unionByName(parts[2]))
