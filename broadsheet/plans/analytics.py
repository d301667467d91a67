"""Timelines, distributions, summaries, topics and keyword analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.operators import health, keywords, trends
from broadsheet.plans import sqlparts as Q
from broadsheet.plans.registry import query
from broadsheet.sources import tables as TB

NOW = TB.AS_OF
WEEK = Q.days_ago(7)
MONTH = Q.days_ago(30)
LABELS_SQL = """count(*) FILTER (sentiment = 'negative') AS negative,
  count(*) FILTER (sentiment = 'neutral') AS neutral, count(*) FILTER (sentiment = 'positive') AS positive"""
FORMATS = {"hour": "%Y-%m-%d-%H", "day": "%Y-%m-%d", "week": "%G-%V"}


def processed(spark, sf_dir):
    return TB.with_keywords(TB.articles(spark, sf_dir), Q.STOPWORDS)


@query(
    "sentiment_distribution",
    f"WITH {Q.ARTICLES} SELECT {LABELS_SQL} FROM articles WHERE published_at >= {WEEK} AND category = 'economy'",
)
def sentiment_distribution(spark, sf_dir):
    return trends.sentiment_distribution(TB.labelled(spark, sf_dir), NOW, "economy")


@query(
    "sentiment_distribution_long",
    f"""WITH {Q.ARTICLES}, wide AS (SELECT {LABELS_SQL} FROM articles WHERE published_at >= {MONTH})
    SELECT label, "count" FROM (UNPIVOT wide ON negative, neutral, positive INTO NAME label VALUE "count")""",
)
def sentiment_distribution_long(spark, sf_dir):
    return trends.distribution_rows(trends.sentiment_distribution(TB.labelled(spark, sf_dir), NOW, days=30))


@query(
    "category_summary",
    f"""WITH {Q.ARTICLES} SELECT category, count(*) AS article_count, {LABELS_SQL}, {WEEK} AS "start", {Q.NOW} AS "end"
    FROM articles WHERE published_at >= {WEEK} GROUP BY category""",
)
def category_summary(spark, sf_dir):
    return trends.category_summary(TB.labelled(spark, sf_dir), NOW)


@query(
    "stats_summary",
    f"""WITH {Q.ARTICLES}, sent AS (
      SELECT CASE WHEN press = 'src7' THEN 'sports' ELSE category END AS category, sentiment, published_at FROM articles)
    SELECT category, article_count, negative, neutral, positive, {WEEK} AS "start", {Q.NOW} AS "end" FROM (
      SELECT category, grouping(category) AS g, count(*) AS article_count, {LABELS_SQL}
      FROM sent WHERE published_at >= {WEEK} GROUP BY GROUPING SETS ((category), ()))
    WHERE g = 1 OR list_contains({Q.quoted(TB.CATEGORIES)}, category)""",
)
def stats_summary(spark, sf_dir):
    # Source 7 writes a category outside the known seven; it counts in the total only.
    sent = TB.labelled(spark, sf_dir).withColumn(
        "category", F.when(F.col("press") == "src7", "sports").otherwise(F.col("category"))
    )
    return trends.stats_summary(sent, NOW).drop("is_total")


def _timelines(interval):
    bucket = f"strftime(published_at, '{FORMATS[interval]}')"

    @query(
        f"timeline_{interval}",
        f"""WITH {Q.ARTICLES} SELECT {bucket} AS bucket, count(*) AS "count" FROM articles
        WHERE published_at >= {MONTH} GROUP BY 1""",
    )
    def timeline(spark, sf_dir):
        return trends.timeline(TB.articles(spark, sf_dir), NOW, interval)

    @query(
        f"sentiment_trends_{interval}",
        f"""WITH {Q.ARTICLES} SELECT {bucket} AS bucket, {LABELS_SQL} FROM articles
        WHERE published_at >= {MONTH} AND sentiment IS NOT NULL GROUP BY 1""",
    )
    def sentiment_trends(spark, sf_dir):
        return trends.sentiment_trends(TB.labelled(spark, sf_dir), NOW, interval)


for _interval in FORMATS:
    _timelines(_interval)


@query(
    "timeline_filtered",
    f"""WITH {Q.ARTICLES} SELECT strftime(published_at, '%Y-%m-%d') AS bucket, count(*) AS "count" FROM articles
    WHERE published_at >= {MONTH} AND category = 'world' AND sentiment = 'positive' GROUP BY 1""",
)
def timeline_filtered(spark, sf_dir):
    rows = TB.labelled(spark, sf_dir)
    return trends.timeline(rows, NOW, "no such interval", category="world", sentiment="positive")


@query(
    "sentiment_trends_map",
    f"""WITH {Q.ARTICLES}, c AS (
      SELECT strftime(published_at, '%Y-%m-%d') AS bucket, sentiment, count(*) AS n FROM articles
      WHERE published_at >= {MONTH} AND sentiment IS NOT NULL GROUP BY ALL)
    SELECT bucket, string_agg(sentiment || '=' || n, ',' ORDER BY sentiment) AS counts FROM c GROUP BY bucket""",
)
def sentiment_trends_map(spark, sf_dir):
    found = trends.sentiment_trend_map(TB.labelled(spark, sf_dir), NOW)
    pairs = F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return found.select("bucket", F.array_join(pairs, ",").alias("counts"))


@query(
    "sentiment_trend_points",
    f"""WITH {Q.ARTICLES} SELECT strftime(published_at, '%Y-%m-%d') AS bucket, {LABELS_SQL}, count(*) AS total
    FROM articles WHERE published_at >= {MONTH} AND sentiment IS NOT NULL AND category = 'society' GROUP BY 1""",
)
def sentiment_trend_points(spark, sf_dir):
    return trends.sentiment_points(TB.labelled(spark, sf_dir), NOW, category="society")


# --- topics ----------------------------------------------------------------

_TOP_TOPICS_SQL = f"""{Q.TOPICS}, c AS (
  SELECT category, t AS topic, count(*) AS n
  FROM (SELECT category, unnest(main_topics) AS t FROM topics WHERE published_at >= {WEEK}) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, topic) AS rank FROM c)"""


@query(
    "category_top_topics",
    f"""WITH {_TOP_TOPICS_SQL} SELECT category, topic, n AS "count", keywords, rank FROM r JOIN words USING (topic)
    WHERE rank <= 5""",
)
def category_top_topics(spark, sf_dir):
    found = trends.top_topics(TB.with_topics(TB.articles(spark, sf_dir)), NOW)
    return found.withColumn("keywords", F.array_join("keywords", ","))


_TOPIC_LISTS_SQL = f"""{_TOP_TOPICS_SQL}, lists_ AS (
      SELECT category, string_agg(topic || ':' || n || ':' || keywords, ';' ORDER BY rank) AS top_topics
      FROM r JOIN words USING (topic) WHERE rank <= 5 GROUP BY category)"""


def _listed_topics(df):
    shown = F.transform("top_topics", lambda t: F.concat_ws(":", t["topic"], t["count"], F.array_join(t["keywords"], ",")))
    return df.withColumn("top_topics", F.array_join(shown, ";"))


@query(
    "category_summary_topics",
    f"""WITH {_TOPIC_LISTS_SQL}, counted AS (
      SELECT category, count(*) AS article_count, {LABELS_SQL}, {WEEK} AS "start", {Q.NOW} AS "end"
      FROM articles WHERE published_at >= {WEEK} GROUP BY category)
    SELECT c.*, coalesce(top_topics, '') AS top_topics FROM counted c LEFT JOIN lists_ USING (category)""",
)
def category_summary_topics(spark, sf_dir):
    articles = TB.with_topics(TB.labelled(spark, sf_dir))
    return _listed_topics(trends.with_top_topics(trends.category_summary(articles, NOW), articles, NOW))


@query(
    "stats_summary_topics",
    f"""WITH {_TOPIC_LISTS_SQL}, counted AS (
      SELECT category, count(*) AS article_count, {LABELS_SQL}, {WEEK} AS "start", {Q.NOW} AS "end"
      FROM articles WHERE published_at >= {WEEK} GROUP BY GROUPING SETS ((category), ()))
    SELECT c.*, coalesce(top_topics, '') AS top_topics FROM counted c LEFT JOIN lists_ l ON l.category = c.category""",
)
def stats_summary_topics(spark, sf_dir):
    articles = TB.with_topics(TB.labelled(spark, sf_dir))
    total = trends.stats_summary(articles, NOW).drop("is_total")
    return _listed_topics(trends.with_top_topics(total, articles, NOW))


@query(
    "topic_labels",
    f"""WITH {_TOP_TOPICS_SQL} SELECT category, 'Topic ' || topic AS label, n AS "count",
      array_to_string(string_split(keywords, ',')[1:5], ', ') AS short_words, replace(keywords, ',', ', ') AS words
    FROM r JOIN words USING (topic) WHERE rank <= 5""",
)
def topic_labels(spark, sf_dir):
    return trends.topic_labels(trends.top_topics(TB.with_topics(TB.articles(spark, sf_dir)), NOW))


@query(
    "topic_sentiment",
    f"""WITH {Q.TOPICS} SELECT topic_id, count(*) AS article_count, {LABELS_SQL}
    FROM (SELECT sentiment, unnest(main_topics) AS topic_id FROM topics WHERE published_at >= {WEEK}) GROUP BY 1""",
)
def topic_sentiment(spark, sf_dir):
    return trends.topic_sentiment(TB.with_topics(TB.labelled(spark, sf_dir)), NOW)


# --- keywords --------------------------------------------------------------

_WINDOW_SQL = f"kw WHERE processed_at >= {WEEK}"


@query(
    "trending_keywords",
    f"""WITH {Q.keyword_ctes()} SELECT keyword, count(*) AS "count"
    FROM (SELECT unnest(keywords) AS keyword FROM {_WINDOW_SQL})
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def trending_keywords(spark, sf_dir):
    return keywords.trending(processed(spark, sf_dir), NOW)


@query(
    "trending_keywords_category",
    f"""WITH {Q.keyword_ctes()} SELECT keyword, count(*) AS "count"
    FROM (SELECT unnest(keywords) AS keyword FROM kw WHERE processed_at >= {MONTH} AND category = 'politics')
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""",
)
def trending_keywords_category(spark, sf_dir):
    return keywords.trending(processed(spark, sf_dir), NOW, "politics", days=30, limit=50)


@query(
    "keyword_scores",
    f"""WITH {Q.keyword_ctes()}, w AS (SELECT url, keywords FROM {_WINDOW_SQL} AND len(keywords) > 0),
    n AS (SELECT count(*) AS total FROM w),
    c AS (SELECT keyword, count(*) AS cnt, count(DISTINCT url) AS df
      FROM (SELECT url, unnest(keywords) AS keyword FROM w) GROUP BY 1)
    SELECT keyword, cnt AS "count", df AS doc_count, round(cnt * ln((total + 1) / (df + 1)), 6) AS score,
      total AS total_articles FROM c, n ORDER BY score DESC, keyword LIMIT 20""",
)
def keyword_scores(spark, sf_dir):
    return keywords.keyword_scores(processed(spark, sf_dir), NOW)


@query(
    "keyword_sentiment",
    f"""WITH {Q.keyword_ctes()} SELECT keyword, count(*) AS "count", {LABELS_SQL}
    FROM (SELECT sentiment, unnest(keywords) AS keyword FROM {_WINDOW_SQL})
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def keyword_sentiment(spark, sf_dir):
    df = TB.with_keywords(TB.labelled(spark, sf_dir), Q.STOPWORDS)
    return keywords.keyword_sentiment(df, NOW)


_CENTER = "on"
_NETWORK_SQL = f"""{Q.keyword_ctes()},
docs AS (SELECT doc_id, keywords FROM {_WINDOW_SQL}),
flat AS (SELECT doc_id, unnest(keywords) AS k FROM docs),
pairs AS (SELECT a.k AS source, b.k AS target, count(*) AS weight
  FROM flat a JOIN flat b ON a.doc_id = b.doc_id AND a.k <> b.k GROUP BY ALL),
best AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY weight DESC, target) AS rk FROM pairs) WHERE rk <= 10),
edges AS (
  SELECT source, target, weight, 1 AS depth FROM best WHERE source = '{_CENTER}'
  UNION ALL
  SELECT source, target, weight, 2 FROM best WHERE source <> '{_CENTER}'
    AND source IN (SELECT target FROM best WHERE source = '{_CENTER}'))"""


@query(
    "keyword_network_edges",
    f"WITH {_NETWORK_SQL} SELECT source, target, weight, depth FROM edges WHERE depth = 1",
)
def keyword_network_edges(spark, sf_dir):
    return keywords.network_edges(processed(spark, sf_dir), _CENTER.upper(), NOW)


@query(
    "keyword_network_nodes",
    f"""WITH {_NETWORK_SQL} SELECT '{_CENTER}' AS id, 1 AS "group", 20 AS size
    WHERE EXISTS (SELECT 1 FROM flat WHERE k = '{_CENTER}')
    UNION ALL SELECT target, 2, 10 + weight FROM edges WHERE depth = 1""",
)
def keyword_network_nodes(spark, sf_dir):
    df = processed(spark, sf_dir)
    return keywords.network_nodes(df, keywords.network_edges(df, _CENTER, NOW), _CENTER, NOW)


@query("keyword_network_depth2", f"WITH {_NETWORK_SQL} SELECT source, target, weight, depth FROM edges")
def keyword_network_depth2(spark, sf_dir):
    return keywords.network_edges(processed(spark, sf_dir), _CENTER, NOW, depth=2)


# --- statistics and display ------------------------------------------------


@query(
    "job_stats",
    """SELECT event_type, count(*) AS items, round(sum(CAST(value AS DECIMAL(18, 4))), 4)::DOUBLE AS total_seconds,
      round(CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) / count(*), 4) AS mean_seconds
    FROM events GROUP BY event_type""",
)
def job_stats(spark, sf_dir):
    # Decimal sums do not depend on the order in which tasks finish.
    seconds = F.col("value").cast("decimal(18,4)")
    stats = trends.job_stats(TB.table(spark, sf_dir, "events"), seconds, "event_type")
    return stats.select(
        "event_type",
        "items",
        F.col("total_seconds").cast("double").alias("total_seconds"),
        F.round(F.col("total_seconds").cast("double") / F.col("items"), 4).alias("mean_seconds"),
    )


@query(
    "article_cards",
    f"""WITH {Q.ARTICLES} SELECT url, title, press, category, strftime(published_at, '%Y-%m-%dT%H:%M:%S') AS published_at,
      sentiment, CASE WHEN sentiment IS NOT NULL THEN CAST(sentiment = 'positive' AS DOUBLE) END AS score_positive,
      CASE WHEN sentiment IS NOT NULL THEN CAST(sentiment = 'neutral' AS DOUBLE) END AS score_neutral,
      CASE WHEN sentiment IS NOT NULL THEN CAST(sentiment = 'negative' AS DOUBLE) END AS score_negative,
      left(content, 300) || '...' AS preview FROM articles""",
)
def article_cards(spark, sf_dir):
    return health.article_cards(TB.labelled(spark, sf_dir))


@query(
    "sentiment_score_rows",
    f"""WITH {Q.ARTICLES} SELECT url, label, CAST(label = sentiment AS DOUBLE) AS score
    FROM articles, (VALUES ('negative'), ('neutral'), ('positive')) l(label) WHERE sentiment IS NOT NULL""",
)
def sentiment_score_rows(spark, sf_dir):
    scores = F.col("sentiment_analysis.overall_sentiment.scores")
    rows = TB.labelled(spark, sf_dir).where(S.label_of().isNotNull())
    return rows.select("url", F.explode(scores).alias("label", "score"))
