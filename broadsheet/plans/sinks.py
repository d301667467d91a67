"""The sink job, tables changed in place, and what is read from them."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.functions import topics as TP
from broadsheet.operators import index, ledger, search, sink, views
from broadsheet.plans import sqlparts as Q
from broadsheet.plans.registry import query
from broadsheet.schemas import STAGE_RETENTION_DAYS, STAGE_TABLES
from broadsheet.session import fresh_path
from broadsheet.sources import messages as M
from broadsheet.sources import tables as TB
from broadsheet.sources.keyed import KeyedTable
from broadsheet.streaming import jobs

NOW = TB.AS_OF
SHOWN = ("url", "title", "press", "category", "published_at", "collected_at")


def shown(rows: DataFrame, table: str) -> DataFrame:
    """The rows of one stage table in the columns that all four share."""
    none = F.lit(None)
    return rows.select(
        F.lit(table).alias("table_name"),
        *SHOWN,
        F.array_join("keywords", " ").alias("keywords"),
        (F.col("processed_at") if "processed_at" in rows.columns else none.cast("timestamp_ntz")).alias("processed_at"),
        (S.label_of() if "sentiment_analysis" in rows.columns else none.cast("string")).alias("sentiment"),
        (F.col("summary") if "summary" in rows.columns else none.cast("string")).alias("summary"),
    )


def stage_tables(spark, path: str) -> DataFrame:
    parts = [shown(sink.table_of(spark, path, t).read(), t) for t in STAGE_TABLES.values() if sink.table_of(spark, path, t).exists()]
    return reduce(DataFrame.unionByName, parts)


@query("sink_tables", f"WITH {Q.STAGE_ROWS} SELECT * FROM stage_rows")
def sink_tables(spark, sf_dir):
    path = fresh_path(spark, "sink")
    sink.log_batch(TB.as_sink_messages(TB.labelled(spark, sf_dir)), 0, path, NOW)
    sink.fold(spark, path)
    return stage_tables(spark, path)


@query("stream_sink", f"WITH {Q.STAGE_ROWS} SELECT * FROM stage_rows")
def stream_sink(spark, sf_dir):
    path = fresh_path(spark, "stream-sink")
    articles = TB.with_stage_times(TB.as_articles(jobs.read_table_stream(spark, sf_dir, "documents")))
    labelled = TB.with_labels(articles, TB.table(spark, sf_dir, "labels"))
    jobs.sink_job(TB.as_sink_messages(labelled), path, f"{path}/checkpoint", NOW)
    return stage_tables(spark, path)


@query(
    "sink_rejected",
    f"""WITH {Q.MESSAGES} SELECT topic, doc_id * 2 + e AS message_no, coalesce(reject_reason, 'missing summary') AS reject_reason
    FROM messages, (VALUES (1), (2)) v(e)
    WHERE topic LIKE 'news.%' AND (reject_reason IS NOT NULL OR (stage = 'summary' AND n_chars % 7 = 0))""",
)
def sink_rejected(spark, sf_dir):
    path = fresh_path(spark, "sink")
    sink.log_batch(TB.as_sink_messages(TB.labelled(spark, sf_dir)), 0, path, NOW)
    return sink.rejected(spark, path).select("topic", F.col("offset").alias("message_no"), "reject_reason")


# --- changes in place --------------------------------------------------------

STORED = ("url", "press", "category", "published_at", "sentiment")


def stored_table(spark, sf_dir, by_day: bool = False) -> KeyedTable:
    rows = TB.labelled(spark, sf_dir).select(*STORED, F.to_date("published_at").alias("day"))
    return KeyedTable(spark, fresh_path(spark, "articles"), partition_by=["day"] if by_day else []).create(rows)


@query(
    "update_table",
    f"""WITH {Q.ARTICLES}, u AS (SELECT *, coalesce(sentiment = 'negative' AND category <> 'society', false) AS hit FROM articles)
    SELECT url, CASE WHEN hit THEN 'withheld' ELSE press END AS press, CASE WHEN hit THEN 'society' ELSE category END AS category,
      published_at, sentiment, (SELECT count(*) FROM u WHERE hit) AS changed_rows, 0 AS changed_again
    FROM u""",
)
def update_table(spark, sf_dir):
    table = stored_table(spark, sf_dir)
    condition = (F.col("sentiment") == "negative") & (F.col("category") != "society")
    new = {"press": F.lit("withheld"), "category": F.lit("society")}
    changed, again = table.update(condition, new), table.update(condition, new)
    return table.read().drop("day").withColumns({"changed_rows": F.lit(changed).cast("long"), "changed_again": F.lit(again)})


@query(
    "delete_table",
    f"""WITH {Q.ARTICLES} SELECT url, press, category, published_at, sentiment,
      (SELECT count(*) FROM articles WHERE sentiment = 'negative') AS deleted_rows
    FROM articles WHERE sentiment IS NULL OR sentiment <> 'negative'""",
)
def delete_table(spark, sf_dir):
    table = stored_table(spark, sf_dir)
    gone = table.delete(F.col("sentiment") == "negative")
    return table.read().drop("day").withColumn("deleted_rows", F.lit(gone).cast("long"))


@query(
    "expire_table",
    f"""WITH {Q.ARTICLES} SELECT url, press, category, published_at, sentiment,
      (SELECT count(*) FROM articles WHERE published_at < {Q.days_ago(STAGE_RETENTION_DAYS['processed'])}) AS expired_rows
    FROM articles WHERE published_at >= {Q.days_ago(STAGE_RETENTION_DAYS['processed'])}""",
)
def expire_table(spark, sf_dir):
    table = stored_table(spark, sf_dir, by_day=True)
    limit = datetime.fromisoformat(NOW) - timedelta(days=STAGE_RETENTION_DAYS["processed"])
    gone = table.expire("day", limit)
    return table.read().drop("day").withColumn("expired_rows", F.lit(gone).cast("long"))


@query("article_by_url", f"WITH {Q.ARTICLES} SELECT url, press, category, published_at, sentiment FROM articles WHERE url = 'https://example.org/a/42'")
def article_by_url(spark, sf_dir):
    """Encoded url of a request, looked up in a table in key order."""
    return stored_table(spark, sf_dir).lookup(unquote("https%3A%2F%2Fexample.org%2Fa%2F42")).drop("day")


# --- views kept up with corrections ------------------------------------------

#: Three batches: all articles, corrections of the good ones, corrections of the toxic ones.
CORRECTED = f"""{Q.keyword_ctes()},
final AS (
  SELECT doc_id, CASE WHEN quality = 1 THEN 'world' ELSE category END AS category,
    published_at + CASE WHEN quality = 1 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS published_at, processed_at,
    CASE WHEN toxic = 1 THEN 'neutral' ELSE sentiment END AS sentiment,
    CASE WHEN toxic = 1 THEN ['retracted'] WHEN quality = 1 THEN keywords[:3] ELSE keywords END AS keywords
  FROM kw)"""


def corrected_batches(articles: DataFrame) -> list[DataFrame]:
    good = articles.where("quality = 1").withColumns(
        {
            "category": F.lit("world"),
            "published_at": F.col("published_at") + F.expr("INTERVAL 1 DAY"),
            "keywords": F.slice("keywords", 1, 3),
        }
    )
    moved = F.when(F.col("quality") == 1, F.col("published_at") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("published_at"))
    toxic = articles.where("toxic = 1").withColumns(
        {
            "category": F.when(F.col("quality") == 1, "world").otherwise(F.col("category")),
            "published_at": moved,
            "sentiment_analysis": S.analysis(S.one_hot(F.lit("neutral"))),
            "keywords": F.array(F.lit("retracted")),
        }
    )
    columns = ("url", "category", "published_at", "processed_at", "keywords", "sentiment_analysis")
    return [b.select(*columns, F.lit(i).alias("ingest_seq")) for i, b in enumerate([articles, good, toxic])]


def corrected_views(spark, sf_dir) -> str:
    path = fresh_path(spark, "views")
    articles = TB.with_keywords(TB.labelled(spark, sf_dir), Q.STOPWORDS)
    table = KeyedTable(spark, f"{path}/table")
    for number, batch in enumerate(corrected_batches(articles)):
        views.apply_batch(table, batch, "ingest_seq", number, path)
        if number == 1:
            views.compact(spark, path, table)
    return path


_IN_WINDOW = f"{Q.days_ago(30)} AND published_at < {Q.NOW}"


@query(
    "serving_timeline",
    f"""WITH {CORRECTED} SELECT strftime(published_at, '%Y-%m-%d') AS bucket, count(*) AS "count",
      count(*) FILTER (sentiment = 'neutral') AS "neutral"
    FROM final WHERE published_at >= {_IN_WINDOW} GROUP BY 1""",
)
def serving_timeline(spark, sf_dir):
    counts = views.counts(spark, corrected_views(spark, sf_dir), "articles")
    every = views.timeline(counts, NOW)
    neutral = views.timeline(counts, NOW, sentiment="neutral").withColumnRenamed("count", "neutral")
    return every.join(neutral, "bucket", "left").fillna(0, ["neutral"])


@query(
    "serving_trending",
    f"""WITH {CORRECTED} SELECT keyword, count(*) AS "count"
    FROM (SELECT unnest(keywords) AS keyword FROM final WHERE processed_at >= {Q.days_ago(7)} AND processed_at < {Q.NOW})
    WHERE keyword <> '' GROUP BY keyword ORDER BY 2 DESC, 1 LIMIT 20""",
)
def serving_trending(spark, sf_dir):
    return views.trending(views.counts(spark, corrected_views(spark, sf_dir), "keywords"), NOW)


@query(
    "serving_distribution",
    f"""WITH {CORRECTED} SELECT count(*) FILTER (sentiment = 'negative') AS negative,
      count(*) FILTER (sentiment = 'neutral') AS neutral, count(*) FILTER (sentiment = 'positive') AS positive
    FROM final WHERE published_at >= {Q.days_ago(14)} AND published_at < {Q.NOW}""",
)
def serving_distribution(spark, sf_dir):
    return views.distribution(views.counts(spark, corrected_views(spark, sf_dir), "articles"), NOW, days=14)


# --- archive with a ledger -----------------------------------------------------


@query(
    "archive_ledger",
    rf"""WITH {Q.MESSAGES}, raw AS (SELECT * FROM messages WHERE regexp_matches(topic, 'news\..*\.raw')),
    half AS (SELECT max(doc_id) // 2 AS h FROM raw)
    SELECT topic, split_part(topic, '.', 2) AS category, doc_id % 3 AS "partition", doc_id AS message_no,
      CASE WHEN coalesce(toxic, 0) <> 1 THEN title END AS title,
      (SELECT count(*) FROM raw, half WHERE doc_id <= h) AS first_run, (SELECT count(*) FROM raw, half WHERE doc_id > h) AS second_run,
      0 AS third_run
    FROM raw""",
)
def archive_ledger(spark, sf_dir):
    """A first run up to an offset, a replay from the start, and one more: every message once."""
    path = fresh_path(spark, "ledger")
    raw = M.by_pattern(TB.messages(spark, sf_dir), TP.RAW_PATTERN).withColumn("partition", (F.col("offset") % 3).cast("int"))
    half = raw.agg((F.max("offset") / 2).cast("long").alias("h")).first().h or 0
    runs = [ledger.archive(raw.where(F.col("offset") <= half), path), ledger.archive(raw, path), ledger.archive(raw, path)]
    rows = M.decode(ledger.stored(spark, path))
    whole = F.col(f"record.{M.CORRUPT}").isNull()
    counts = {n: F.lit(c).cast("long") for n, c in zip(("first_run", "second_run", "third_run"), runs, strict=True)}
    return rows.select(
        "topic", "category", "partition", F.col("offset").alias("message_no"), F.when(whole, F.col("record.title")).alias("title")
    ).withColumns(counts)


# --- search over the index -----------------------------------------------------

CARD = ("url", "title", "press", "category", "published_at")


@query(
    "search_indexed",
    f"""WITH {Q.keyword_ctes()}, hits AS (
      SELECT * FROM kw
      WHERE (contains(lower(title), 'th') OR contains(lower(title), 'on') OR list_has_any(keywords, ['th', 'on']))
        AND category IN ('economy', 'society', 'it') AND sentiment IN ('positive', 'neutral')
        AND published_at BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-28 00:00:00'
        AND list_has_all(keywords, ['is']) AND NOT list_has_any(keywords, ['des']))
    SELECT {", ".join(CARD)}, (SELECT count(*) FROM hits) AS total FROM hits ORDER BY published_at DESC, url LIMIT 20""",
)
def search_indexed(spark, sf_dir):
    path = fresh_path(spark, "index")
    index.build(TB.with_keywords(TB.labelled(spark, sf_dir), Q.STOPWORDS), path)
    request = search.SearchRequest(
        query="th on",
        categories=["economy", "society", "it"],
        sentiments=["positive", "neutral"],
        start_date="2024-01-02 00:00:00",
        end_date="2024-01-28 00:00:00",
        include_keywords=["is"],
        exclude_keywords=["des"],
    )
    return index.find(spark, path, request).select(*CARD, "total")


@query(
    "index_terms",
    f"""WITH {Q.keyword_ctes()} SELECT 'keyword' AS field, term, count(*) AS articles
    FROM (SELECT unnest(keywords) AS term FROM kw) GROUP BY term
    UNION ALL SELECT 'title', term, count(*) FROM (
      SELECT unnest(list_distinct(string_split_regex(lower(title), '[ \t\n\x0B\f\r]+'))) AS term FROM kw) WHERE term <> '' GROUP BY term""",
)
def index_terms(spark, sf_dir):
    """Articles per title word and keyword, read from the index alone."""
    path = fresh_path(spark, "index")
    index.build(TB.with_keywords(TB.labelled(spark, sf_dir), Q.STOPWORDS), path)
    return index.postings(spark, path).groupBy("field", "term").agg(F.count(F.lit(1)).alias("articles"))
