"""Routing, sinks and table changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.functions import topics as TP
from broadsheet.operators import ingest, store
from broadsheet.plans import sqlparts as Q
from broadsheet.plans.registry import query
from broadsheet.schemas import STAGE_RETENTION_DAYS
from broadsheet.session import fresh_path
from broadsheet.sources import messages as M
from broadsheet.sources import tables as TB

NOW = TB.AS_OF
CHANGED = ("url", "title", "press", "category", "published_at", "sentiment")


@query(
    "route_by_category",
    f"WITH {Q.ARTICLES} SELECT url, 'news.' || category || '.processed' AS topic FROM articles",
)
def route_by_category(spark, sf_dir):
    return ingest.route_by_category(TB.articles(spark, sf_dir), "processed").select("url", "topic")


@query(
    "route_by_topic",
    f"WITH {Q.MESSAGES} SELECT doc_id AS message_no, 'news.' || split_part(topic, '.', 2) || '.sentiment' AS target_topic FROM messages",
)
def route_by_topic(spark, sf_dir):
    routed = ingest.route_by_topic(TB.messages(spark, sf_dir), "processed", "sentiment")
    return routed.select(F.col("offset").alias("message_no"), "target_topic")


@query(
    "route_by_topic_known",
    rf"""WITH {Q.MESSAGES} SELECT doc_id AS message_no, 'news.' || c || '.summary' AS target_topic
    FROM (SELECT *, regexp_extract(topic, '^news\.(.*)\.processed$', 1) AS c FROM messages)
    WHERE list_contains({Q.quoted(TB.CATEGORIES)}, c)""",
)
def route_by_topic_known(spark, sf_dir):
    routed = ingest.route_by_topic(TB.messages(spark, sf_dir), "processed", "summary", known_only=True)
    return routed.select(F.col("offset").alias("message_no"), "target_topic")


_ARCHIVED_SQL = r"regexp_matches(topic, 'news\..*\.raw')"


@query(
    "archive_by_category",
    f"""WITH {Q.MESSAGES} SELECT split_part(topic, '.', 2) AS category, count(*) AS messages
    FROM messages WHERE {_ARCHIVED_SQL} GROUP BY 1""",
)
def archive_by_category(spark, sf_dir):
    path = fresh_path(spark, "archive")
    ingest.archive(M.by_pattern(TB.messages(spark, sf_dir), TP.RAW_PATTERN), path)
    stored = spark.read.schema("topic string, value string, offset bigint, category string").json(path)
    return stored.groupBy("category").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "archive_stats",
    f"""WITH {Q.MESSAGES} SELECT split_part(topic, '.', 2) AS category, count(*) AS messages,
      count(*) FILTER (reject_reason IS NULL) AS stored, count(*) FILTER (reject_reason IS NOT NULL) AS failed
    FROM messages GROUP BY 1""",
)
def archive_stats(spark, sf_dir):
    checked = M.checked(TB.messages(spark, sf_dir))
    return ingest.archive_stats(checked, F.col("reject_reason").isNotNull())


@query(
    "sink_dispatch",
    f"""WITH {Q.MESSAGES} SELECT doc_id AS message_no, topic, stage || '_articles' AS table_name FROM messages
    WHERE topic LIKE 'news.%' AND stage <> 'raw'""",
)
def sink_dispatch(spark, sf_dir):
    sent = ingest.dispatch(TB.messages(spark, sf_dir))
    return sent.select(F.col("offset").alias("message_no"), "topic", "table_name")


@query("upsert_latest", f"WITH {Q.CHANGES} SELECT url, title, press, sentiment, ingest_seq FROM latest")
def upsert_latest(spark, sf_dir):
    return store.latest_per_key(TB.changes(spark, sf_dir))


_MERGED_SQL = """SELECT coalesce(l.url, a.url) AS url,
      CASE WHEN l.url IS NOT NULL THEN l.title ELSE a.title END AS title,
      CASE WHEN l.url IS NOT NULL THEN l.press ELSE a.press END AS press, a.category, a.published_at,
      CASE WHEN l.url IS NOT NULL THEN l.sentiment END AS sentiment
    FROM articles a FULL JOIN latest l ON l.url = a.url"""


@query("upsert_merge", f"WITH {Q.CHANGES} {_MERGED_SQL}")
def upsert_merge(spark, sf_dir):
    return store.upsert_merge(TB.existing_table(spark, sf_dir), TB.changes(spark, sf_dir)).select(*CHANGED)


@query(
    "serving_view",
    f"""WITH {Q.CHANGES}, both_views AS (
      SELECT url, title, press, CAST(NULL AS VARCHAR) AS sentiment, 0 AS ingest_seq FROM articles
      UNION ALL SELECT url, title, press, sentiment, ingest_seq FROM changes)
    SELECT url, title, press, sentiment, ingest_seq FROM (
      SELECT *, row_number() OVER (PARTITION BY url ORDER BY ingest_seq DESC) AS rk FROM both_views) WHERE rk = 1""",
)
def serving_view(spark, sf_dir):
    batch = TB.existing_table(spark, sf_dir).select("url", "title", "press", "sentiment", F.lit(0).alias("ingest_seq"))
    return store.serving_view(batch, TB.changes(spark, sf_dir))


@query(
    "stamp_stage",
    f"""WITH {Q.ARTICLES} SELECT url, coalesce(CASE WHEN lang = 'en' THEN collected_at END, {Q.NOW}) AS collected_at,
      {Q.NOW} AS summary_processed_at FROM enriched""",
)
def stamp_stage(spark, sf_dir):
    sent = TB.articles(spark, sf_dir).withColumn("collected_at", F.when(F.col("lang") == "en", F.col("collected_at")))
    return store.stamp(store.stamp(sent, "raw", NOW), "summary", NOW).select("url", "collected_at", "summary_processed_at")


@query(
    "insert_many",
    f"""WITH {Q.ARTICLES}, {Q.PAGE_ARTICLES} SELECT url, title, press, category FROM articles
    UNION ALL SELECT url, title, press, NULL FROM page_articles""",
)
def insert_many(spark, sf_dir):
    stored = TB.articles(spark, sf_dir).select("url", "title", "press", "category")
    return store.insert_many(stored, TB.page_articles(spark, sf_dir).select("url", "title", "press"))


@query(
    "union_sources",
    f"""WITH {Q.ARTICLES}, {Q.PAGE_ARTICLES}, all_rows AS (
      SELECT press, content FROM articles UNION ALL SELECT press, content FROM page_articles)
    SELECT press, count(*) AS articles, CAST(sum(length(content)) AS BIGINT) AS chars FROM all_rows GROUP BY press""",
)
def union_sources(spark, sf_dir):
    collected = TB.articles(spark, sf_dir).select("press", "content")
    scraped = TB.page_articles(spark, sf_dir).select("press", "content")
    return (
        store.union_sources(collected, scraped)
        .groupBy("press")
        .agg(F.count(F.lit(1)).alias("articles"), F.sum(F.length("content")).alias("chars"))
    )


@query(
    "update_where",
    f"""WITH {Q.ARTICLES}, u AS (SELECT url, press, category, coalesce(sentiment = 'negative', false) AS hit FROM articles)
    SELECT url, CASE WHEN hit THEN 'withheld' ELSE press END AS press, CASE WHEN hit THEN 'society' ELSE category END AS category,
      hit AS changed FROM u""",
)
def update_where(spark, sf_dir):
    changed = store.update_where(
        TB.labelled(spark, sf_dir),
        F.col("sentiment") == "negative",
        {"press": F.lit("withheld"), "category": F.lit("society")},
    )
    return changed.select("url", "press", "category", "changed")


@query(
    "delete_where",
    f"WITH {Q.ARTICLES} SELECT url, sentiment FROM articles WHERE sentiment IS NULL OR sentiment <> 'negative'",
)
def delete_where(spark, sf_dir):
    return store.delete_where(TB.labelled(spark, sf_dir), F.col("sentiment") == "negative").select("url", "sentiment")


@query(
    "key_violations",
    f"WITH {Q.CHANGES} SELECT url, count(*) AS copies FROM changes GROUP BY url HAVING count(*) > 1",
)
def key_violations(spark, sf_dir):
    return store.key_violations(TB.changes(spark, sf_dir))


@query(
    "retention_filter",
    f"""WITH {Q.MESSAGES}, staged_at AS (SELECT doc_id, published_at, split_part(topic, '.', 3) AS s FROM messages)
    SELECT doc_id AS message_no, s AS stage FROM staged_at
    WHERE {' OR '.join(f"(s = '{k}' AND published_at >= {Q.days_ago(v)})" for k, v in STAGE_RETENTION_DAYS.items())}""",
)
def retention_filter(spark, sf_dir):
    sent = TB.as_messages(TB.labelled(spark, sf_dir), keep=["published_at"])
    staged = sent.withColumn("stage", TP.topic_part(F.col("topic"), 2))
    kept = store.within_retention(staged, F.col("stage"), F.col("published_at"), NOW)
    return kept.select(F.col("offset").alias("message_no"), "stage")
