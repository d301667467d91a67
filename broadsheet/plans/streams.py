"""Streaming queries over the given tables, run once to the end of the input."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.functions import text as X
from broadsheet.functions import topics as TP
from broadsheet.operators import enrich, models, store
from broadsheet.plans import sqlparts as Q
from broadsheet.plans import texts
from broadsheet.plans.registry import query
from broadsheet.schemas import SKIPPED_MODEL_NAME, STAGES
from broadsheet.session import fresh_path
from broadsheet.sources import messages as M
from broadsheet.sources import tables as TB
from broadsheet.streaming import jobs, progress

NOW = TB.AS_OF
LONG_DELAY = "60 days"


def article_stream(spark, sf_dir):
    return TB.with_stage_times(TB.as_articles(jobs.read_table_stream(spark, sf_dir, "documents")))


def labelled_stream(spark, sf_dir, how="left"):
    return TB.with_labels(article_stream(spark, sf_dir), TB.table(spark, sf_dir, "labels"), how)


def message_stream(spark, sf_dir):
    return TB.as_messages(labelled_stream(spark, sf_dir))


@query(
    "stream_text_stage",
    f"""WITH {Q.MESSAGES}, {Q.keyword_ctes().replace(Q.ARTICLES + ',', '').strip()}
    SELECT m.doc_id AS message_no, m.topic, m.reject_reason, CASE WHEN m.reject_reason IS NULL THEN m.url END AS url,
      CASE WHEN m.reject_reason IS NULL THEN array_to_string(kw.keywords, ' ') END AS keywords
    FROM messages m JOIN kw ON kw.doc_id = m.doc_id""",
)
def stream_text_stage(spark, sf_dir):
    path = fresh_path(spark, "stream-text")
    tasks = int(spark.conf.get("spark.broadsheet.tasks", "0")) or None  # as in spread
    jobs.text_job(message_stream(spark, sf_dir), NOW, f"{path}/out", f"{path}/checkpoint", Q.STOPWORDS, tasks)
    done = spark.read.parquet(f"{path}/out")
    return done.select(
        F.col("offset").alias("message_no"),
        "topic",
        "reject_reason",
        "url",
        F.array_join("keywords", " ").alias("keywords"),
    )


@query(
    "stream_fanout",
    f"""WITH {Q.MESSAGES}, p AS (
      SELECT * FROM messages WHERE reject_reason IS NULL AND list_contains({Q.quoted(TB.CATEGORIES)}, split_part(topic, '.', 2))
        AND topic LIKE 'news.%.processed')
    SELECT 'sentiment' AS job, doc_id AS message_no, 'neutral' AS outcome FROM p
    UNION ALL SELECT 'summary', doc_id, CASE WHEN length({Q.strip_sql('content')}) >= 100 THEN 'summarised' ELSE 'skipped' END FROM p""",
)
def stream_fanout(spark, sf_dir):
    path = fresh_path(spark, "stream-fanout")
    topics = TP.topic_list("processed")
    articles = M.accepted(M.checked(M.by_topics(message_stream(spark, sf_dir), topics)))

    def sentiment(df):
        # Without a model every text takes the stored default.
        staged = enrich.sentiment_or_default(df, F.lit(None).cast("array<double>"), NOW)
        return staged.select(F.col("offset").alias("message_no"), S.label_of().alias("outcome"))

    def summary(df):
        staged = enrich.summary_stage(df.withColumn("keywords", X.keywords_of(F.col("content"))), NOW)
        skipped = F.col("summary_info.model_info.name") != enrich.EXTRACTIVE_NAME
        return staged.select(
            F.col("offset").alias("message_no"), F.when(skipped, "skipped").otherwise("summarised").alias("outcome")
        )

    jobs.fan_out(articles, {"sentiment": sentiment, "summary": summary}, f"{path}/out", f"{path}/checkpoint")
    parts = [
        spark.read.parquet(f"{path}/out/{name}").withColumn("job", F.lit(name)) for name in ("sentiment", "summary")
    ]
    return parts[0].unionByName(parts[1])


def first_words(texts: list[str]) -> list[str]:
    """A stand-in for an external summary model."""
    return [text[:60] for text in texts]


@query(
    "stream_summary_job",
    f"""WITH {Q.MESSAGES}, p AS (
      SELECT *, reject_reason IS NULL AS ok FROM messages
      WHERE stage = 'processed' AND topic LIKE 'news.%' AND list_contains({Q.quoted(TB.CATEGORIES)}, split_part(topic, '.', 2)))
    SELECT doc_id AS message_no, CASE WHEN ok THEN 'summary' ELSE 'rejected' END AS outcome,
      'news.' || split_part(topic, '.', 2) || '.summary' AS target_topic, CASE WHEN ok THEN url END AS url,
      CASE WHEN NOT ok THEN '' WHEN length({Q.strip_sql('content')}) >= 100 THEN substr(content, 1, 60) ELSE content END AS summary,
      true AS timed
    FROM p""",
)
def stream_summary_job(spark, sf_dir):
    path = fresh_path(spark, "stream-summary")

    def summarise(df):
        return enrich.summarize_with(df, lambda: first_words, "first words", "external", NOW)

    jobs.summary_job(message_stream(spark, sf_dir), summarise, f"{path}/out", f"{path}/checkpoint")
    info = F.col("summary_info")
    skipped = info["model_info"]["name"] == SKIPPED_MODEL_NAME
    seconds = info["processing_time_seconds"]
    return spark.read.parquet(f"{path}/out").select(
        F.col("offset").alias("message_no"),
        "outcome",
        "target_topic",
        "url",
        info["summary"].alias("summary"),
        F.when(skipped, seconds == 0).otherwise(seconds > 0).alias("timed"),
    )


@query("stream_sentiment_stage", texts.EXTERNAL_SQL)
def stream_sentiment_stage(spark, sf_dir):
    path = fresh_path(spark, "stream-sentiment")
    analysed = models.analyse_sentiment_with(article_stream(spark, sf_dir), texts.length_rule, NOW)
    jobs.to_files(analysed, f"{path}/out", f"{path}/checkpoint")
    return texts.sentiment_columns(spark.read.parquet(f"{path}/out"))


@query(
    "stream_upsert",
    f"""WITH {Q.CHANGES.replace('latest AS', 'latest_all AS')},
    latest AS (SELECT * FROM latest_all WHERE url LIKE 'https://example.org/a/%')
    SELECT coalesce(l.url, a.url) AS url, CASE WHEN l.url IS NOT NULL THEN l.title ELSE a.title END AS title,
      CASE WHEN l.url IS NOT NULL THEN l.press ELSE a.press END AS press, a.category,
      CASE WHEN l.url IS NOT NULL THEN l.sentiment END AS sentiment
    FROM articles a FULL JOIN latest l ON l.url = a.url""",
)
def stream_upsert(spark, sf_dir):
    path = fresh_path(spark, "stream-upsert")
    jobs.upsert_job(TB.as_changes(labelled_stream(spark, sf_dir, "inner")), f"{path}/log", f"{path}/checkpoint")
    merged = store.upsert_merge(TB.existing_table(spark, sf_dir), jobs.latest_changes(spark, f"{path}/log"))
    return merged.select("url", "title", "press", "category", "sentiment")


@query("stream_dedup", f"WITH {Q.ARTICLES} SELECT url, category FROM articles WHERE quality IS NOT NULL")
def stream_dedup(spark, sf_dir):
    path = fresh_path(spark, "stream-dedup")
    sent = labelled_stream(spark, sf_dir, "inner").withColumn("delivery", F.explode(F.sequence(F.lit(1), F.lit(3))))
    unique = jobs.dedup(sent, "url", "published_at", LONG_DELAY, F.col("delivery")).select("url", "category")
    jobs.to_files(unique, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")


@query(
    "stream_archive",
    rf"""WITH {Q.MESSAGES} SELECT split_part(topic, '.', 2) AS category, count(*) AS messages,
      count(*) FILTER (reject_reason = 'malformed json') AS malformed
    FROM messages WHERE regexp_matches(topic, 'news\..*\.raw') GROUP BY 1""",
)
def stream_archive(spark, sf_dir):
    path = fresh_path(spark, "stream-archive")
    raw = M.by_pattern(message_stream(spark, sf_dir), TP.RAW_PATTERN)
    jobs.archive_job(raw, f"{path}/out", f"{path}/checkpoint")
    stored = spark.read.schema("topic string, value string, offset bigint, category string").json(f"{path}/out")
    return stored.groupBy("category").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(~F.col("value").endswith("}")).alias("malformed")
    )


@query("stream_counters", f'WITH {Q.MESSAGES} SELECT topic, count(*) AS "count" FROM messages GROUP BY topic')
def stream_counters(spark, sf_dir):
    path = fresh_path(spark, "stream-counters")
    jobs.keep_latest(jobs.topic_counters(message_stream(spark, sf_dir)), f"{path}/out", f"{path}/checkpoint")
    return jobs.latest_counts(spark, f"{path}/out", ["topic"], ["count"])


@query(
    "stream_timeline",
    f"""WITH {Q.ARTICLES} SELECT date_trunc('day', published_at)::TIMESTAMP AS bucket_start, count(*) AS "count"
    FROM articles GROUP BY 1""",
)
def stream_timeline(spark, sf_dir):
    path = fresh_path(spark, "stream-timeline")
    counts = jobs.live_timeline(article_stream(spark, sf_dir), LONG_DELAY)
    jobs.keep_latest(counts, f"{path}/out", f"{path}/checkpoint")
    return jobs.latest_counts(spark, f"{path}/out", ["bucket_start"], ["count"])


_LABELS = ("negative", "neutral", "positive", "total")


@query(
    "stream_sentiment_trend",
    f"""WITH {Q.ARTICLES} SELECT date_trunc('day', published_at)::TIMESTAMP AS bucket_start,
      count(*) FILTER (sentiment = 'negative') AS negative, count(*) FILTER (sentiment = 'neutral') AS neutral,
      count(*) FILTER (sentiment = 'positive') AS positive, count(*) AS total
    FROM articles WHERE sentiment IS NOT NULL GROUP BY 1""",
)
def stream_sentiment_trend(spark, sf_dir):
    path = fresh_path(spark, "stream-trend")
    counts = jobs.live_sentiment(labelled_stream(spark, sf_dir), LONG_DELAY)
    jobs.keep_latest(counts, f"{path}/out", f"{path}/checkpoint")
    return jobs.latest_counts(spark, f"{path}/out", ["bucket_start"], list(_LABELS))


# --- progress of articles and trending words -----------------------------------

PATIENCE = timedelta(hours=6)


@query(
    "stream_stage_state",
    f"""WITH {Q.ARTICLES}, ev AS (
      SELECT url, 'raw' AS stage, collected_at AS "at" FROM enriched
      UNION ALL SELECT url, 'processed', processed_at FROM enriched WHERE coalesce(toxic, 0) <> 1
      UNION ALL SELECT url, 'sentiment', published_at + INTERVAL 2 HOUR FROM enriched WHERE sentiment IS NOT NULL
      UNION ALL SELECT url, 'summary', published_at + INTERVAL 3 HOUR FROM enriched WHERE n_chars % 7 <> 0),
    seen AS (SELECT url, list(stage) AS stages, min("at") AS begun FROM ev GROUP BY url)
    SELECT url, 'stage' AS event, stage AS stages, "at" FROM ev
    UNION ALL
    SELECT url, 'late', array_to_string(list_filter({Q.quoted(STAGES)}, lambda s: NOT list_contains(stages, s)), ' '),
      begun + INTERVAL 6 HOUR FROM seen
    WHERE len(stages) < 4 AND begun + INTERVAL 6 HOUR <= (SELECT max("at") - INTERVAL 1 HOUR FROM ev)""",
)
def stream_stage_state(spark, sf_dir):
    """Stages of every article, each message delivered twice, and who is late when the stream ends."""
    path = fresh_path(spark, "stream-progress")
    hours = {"sentiment": 2, "summary": 3}
    at = {s: F.col("published_at") + F.expr(f"INTERVAL {h} HOURS") for s, h in hours.items()}
    sent = {
        "raw": F.col("collected_at"),
        "processed": F.when(F.coalesce(F.col("toxic"), F.lit(0)) != 1, F.col("processed_at")),
        "sentiment": F.when(S.label_of().isNotNull(), at["sentiment"]),
        "summary": F.when(F.col("n_chars") % 7 != 0, at["summary"]),
    }
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), t.alias("at")) for s, t in sent.items()])
    twice = F.explode(F.array_repeat(F.lit(0), 2)).alias("delivery")
    events = labelled_stream(spark, sf_dir).select("url", F.explode(stages).alias("e")).where("e.at IS NOT NULL")
    events = events.select("url", "e.stage", "e.at", twice)
    progress.progress_job(events, PATIENCE, timedelta(days=60), f"{path}/out", f"{path}/checkpoint", delay="1 hour")
    done = spark.read.schema(progress.EVENTS).parquet(f"{path}/out")
    return done.withColumn("at", F.col("at").cast("timestamp_ntz"))


@query(
    "stream_trending",
    f"""WITH {Q.keyword_ctes()}, signed AS (
      SELECT processed_at, unnest(CASE WHEN toxic = 1 THEN ['retracted'] ELSE keywords END) AS keyword FROM kw),
    windowed AS (
      SELECT date_trunc('day', processed_at)::TIMESTAMP + to_days(CAST(d AS INT)) AS window_end, keyword, count(*) AS "count"
      FROM signed, (SELECT unnest(range(1, 8)) AS d) days WHERE keyword <> '' GROUP BY ALL)
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY "count" DESC, keyword) AS rank FROM windowed) WHERE rank <= 10""",
)
def stream_trending(spark, sf_dir):
    """Keywords of all articles; a correction takes those of the toxic ones back."""
    path = fresh_path(spark, "stream-trending")
    articles = TB.with_keywords(labelled_stream(spark, sf_dir), Q.STOPWORDS)
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) == 1

    def counted(words, n):
        return F.transform(words, lambda k: F.struct(k.alias("keyword"), F.lit(n).alias("n")))

    none = F.array().cast("array<struct<keyword:string,n:int>>")
    corrected = F.when(toxic, F.concat(counted(F.col("keywords"), -1), counted(F.array(F.lit("retracted")), 1))).otherwise(none)
    signed = articles.select(F.col("processed_at").alias("at"), F.explode(F.concat(counted(F.col("keywords"), 1), corrected)).alias("k"))
    counts = jobs.live_trending(signed.select("at", "k.keyword", "k.n").where("keyword <> ''"), LONG_DELAY)
    jobs.keep_latest(counts, f"{path}/out", f"{path}/checkpoint")
    return jobs.top_keywords(jobs.latest_counts(spark, f"{path}/out", ["window_end", "keyword"], ["count"]))
