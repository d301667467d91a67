"""Article views over the given parquet tables.

Each view is lazy: a query that does not use a column does not pay for it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import pages as P
from broadsheet.functions import sentiment as S
from broadsheet.functions import text as X
from broadsheet.functions import times as TM
from broadsheet.functions import topics as TP
from broadsheet.schemas import CATEGORIES, SECTIONS, STAGES
from broadsheet.session import spread

AS_OF = "2024-01-31 00:00:00"
TOPIC_WORDS = {
    0: ["market", "price", "bank", "trade", "stock", "rate"],
    1: ["court", "police", "school", "health", "city", "law"],
    2: ["summit", "treaty", "border", "embassy", "council", "aid"],
    3: ["chip", "cloud", "mobile", "robot", "network", "code"],
    4: ["film", "music", "museum", "novel", "festival", "art"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_number(source="source"):
    return F.substring(F.col(source), 4, 10).cast("int")


def as_articles(documents: DataFrame) -> DataFrame:
    """Article columns of a documents table; works on a batch or a streaming frame."""
    categories = F.array(*[F.lit(c) for c in CATEGORIES])
    hours = F.make_dt_interval(F.lit(0), ((F.col("doc_id") * 37) % 720).cast("int"))
    return documents.select(
        "doc_id",
        F.concat(F.lit("https://example.org/a/"), F.col("doc_id").cast("string")).alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("content"),
        F.col("source").alias("press"),
        F.get(categories, source_number() % len(CATEGORIES)).alias("category"),
        (TM.moment("2024-01-01 00:00:00") + hours).alias("published_at"),
        "lang",
        "n_chars",
    )


def with_stage_times(articles: DataFrame) -> DataFrame:
    return articles.withColumns(
        {
            "collected_at": F.col("published_at") + F.expr("INTERVAL 10 MINUTES"),
            "processed_at": F.col("published_at") + F.expr("INTERVAL 1 HOUR"),
        }
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_stage_times(as_articles(table(spark, sf_dir, "documents")))


def label_column():
    return (
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .when(F.col("quality") == 0, "neutral")
    )


def with_labels(articles_df: DataFrame, labels: DataFrame, how: str = "left") -> DataFrame:
    """Add ``sentiment`` and the nested ``sentiment_analysis`` record.

    Labels hold one row per document; the join strategy is Catalyst's choice by size.
    ``articles_df`` may be a stream.
    """
    named = labels.select("doc_id", "quality", "toxic", label_column().alias("sentiment"))
    joined = articles_df.join(named, "doc_id", how)
    return joined.withColumn("sentiment_analysis", S.analysis(S.one_hot(F.col("sentiment"))))


def labelled(spark: SparkSession, sf_dir: str, how: str = "left") -> DataFrame:
    return with_labels(articles(spark, sf_dir), table(spark, sf_dir, "labels"), how)


def with_keywords(df: DataFrame, stopwords: Iterable[str] = (), n: int = X.TOP_KEYWORDS) -> DataFrame:
    """Add ``keywords`` from ``content``; a scan with too few splits is spread first."""
    return X.compute_once(spread(df, "doc_id"), "keywords", X.keywords_of(F.col("content"), n, stopwords=stopwords))


def with_topics(df: DataFrame) -> DataFrame:
    """Topic columns by a fixed rule, standing for a topic model's output."""
    main = F.array_distinct(F.array((F.col("doc_id") % 5).cast("int"), (F.col("n_chars") % 5).cast("int")))
    pairs = []
    for topic, words in TOPIC_WORDS.items():
        pairs += [F.lit(str(topic)), F.array(*[F.lit(w) for w in words])]
    return df.withColumns({"main_topics": main, "topic_keywords": F.create_map(*pairs)})


def section_dimension(spark: SparkSession) -> DataFrame:
    """The fixed section table, keyed by its position."""
    rows = [(i, *row) for i, row in enumerate(SECTIONS)]
    return spark.createDataFrame(rows, "position int, site string, section string, category string")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(labelled(spark, sf_dir))


def as_messages(a: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Topic and JSON value per labelled article, with faults where the data has them; columns
    named by ``keep`` stay beside them.

    The language picks the stage. Documents of source 7 carry an unknown category and
    those of source 9 another topic shape. Toxic documents arrive as cut-off JSON, low
    quality ones with an ftp url.
    """
    stage = F.get(
        F.array(*[F.lit(s) for s in STAGES]),
        F.array_position(F.array(F.lit("en"), F.lit("fr"), F.lit("de"), F.lit("es")), F.col("lang")).cast("int") - 1,
    )
    topic = (
        F.when(F.col("press") == "src9", F.lit("other.x.raw"))
        .when(F.col("press") == "src7", TP.topic_name(F.lit("sports"), stage))
        .otherwise(TP.topic_name(F.col("category"), stage))
    )
    url = F.when(F.col("quality") == 0, F.concat(F.lit("ftp://example.org/a/"), F.col("doc_id"))).otherwise(
        F.col("url")
    )
    value = F.to_json(
        F.struct(
            "title",
            "content",
            url.alias("url"),
            "press",
            "category",
            TM.iso(F.col("published_at")).alias("published_at"),
            TM.iso(F.col("collected_at")).alias("collected_at"),
            F.when(F.col("doc_id") % 3 != 0, F.slice(F.split("title", " "), 1, 2)).alias("keywords"),
        )
    )
    broken = F.substring(value, F.lit(1), F.length(value) - 1)
    return a.select(
        topic.alias("topic"),
        F.when(F.col("toxic") == 1, broken).otherwise(value).alias("value"),
        F.col("doc_id").alias("offset"),
        *keep,
    )


def as_sink_messages(a: DataFrame) -> DataFrame:
    """Two editions of every article as messages of its stage, each with that stage's fields.

    Topics, cut-off JSON and ftp urls are those of ``as_messages``. The late edition names another
    press and every fifth one no keywords. One in four lacks its stage's time, one summary in seven
    its text; odd articles carry the sentiment record in its flat shape.
    """
    sent = as_messages(a, keep=["doc_id", "n_chars", "toxic", "quality", "press", "title", "content", "url", "category"]
                       + ["published_at", "collected_at", "processed_at", "sentiment", "sentiment_analysis"])
    late = F.col("edition") == 2
    stage = F.element_at(F.split("topic", r"\."), -1)
    nested = F.col("sentiment_analysis.overall_sentiment")
    own_time = F.when(F.col("doc_id") % 4 != 0, TM.iso(F.col("processed_at")))
    odd = F.col("doc_id") % 2 == 1
    value = F.to_json(
        F.struct(
            "title",
            "content",
            F.when(F.col("quality") == 0, F.concat(F.lit("ftp://example.org/a/"), F.col("doc_id"))).otherwise(F.col("url")).alias("url"),
            F.when(late, F.concat("press", F.lit("-late"))).otherwise(F.col("press")).alias("press"),
            "category",
            TM.iso(F.col("published_at")).alias("published_at"),
            TM.iso(F.col("collected_at")).alias("collected_at"),
            F.when(~late | (F.col("doc_id") % 5 != 0), F.slice(F.split("title", " "), 1, 2)).alias("keywords"),
            F.when(stage != "raw", own_time).alias("processed_at"),
            F.when(
                (stage == "sentiment") & nested.isNotNull(),
                F.struct(
                    F.when(~odd, nested).alias("overall_sentiment"),
                    F.when(odd, nested["sentiment"]).alias("sentiment"),
                    F.when(odd, nested["scores"]).alias("scores"),
                ),
            ).alias("sentiment_analysis"),
            F.when(stage == "sentiment", own_time).alias("sentiment_processed_at"),
            F.when(
                (stage == "summary") & (F.col("n_chars") % 7 != 0), F.struct(F.col("title").alias("summary"))
            ).alias("summary_info"),
            F.when(stage == "summary", own_time).alias("summary_processed_at"),
        )
    )
    editions = sent.withColumn("edition", F.explode(F.array(F.lit(1), F.lit(2))))
    broken = F.substring(value, F.lit(1), F.length(value) - 1)
    return editions.select(
        "topic",
        F.when(F.col("toxic") == 1, broken).otherwise(value).alias("value"),
        (F.col("doc_id") * 2 + F.col("edition")).alias("offset"),
    )


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per page; pages without title or content are dropped."""
    html = F.col("html")
    host = F.parse_url(F.col("url"), F.lit("HOST"))
    fields = F.struct(
        P.page_title(html).alias("title"), P.page_content(html).alias("content"), P.page_press(html, host).alias("press")
    )
    pages = spread(table(spark, sf_dir, "pages"), "page_id")
    extracted = X.compute_once(pages, "fields", fields).select("page_id", "url", "fields.*")
    return extracted.where(F.col("title").isNotNull() & F.col("content").isNotNull())


def as_changes(base: DataFrame) -> DataFrame:
    """Two versions of every labelled article: url, title, press and label, nothing else."""
    versions = F.array(
        F.struct(
            F.concat("title", F.lit(" (first edition)")).alias("title"),
            F.col("press").alias("press"),
            F.lit(1).alias("ingest_seq"),
        ),
        F.struct(
            F.concat("title", F.lit(" (late edition)")).alias("title"),
            F.when(F.col("toxic") == 0, F.col("press")).alias("press"),
            F.lit(2).alias("ingest_seq"),
        ),
    )
    rows = base.withColumn("_v", F.explode(versions))
    return rows.select("url", "_v.title", "_v.press", "sentiment", "_v.ingest_seq")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming records for the upsert: the article changes and one new record per page."""
    fresh = table(spark, sf_dir, "pages").select(
        "url",
        P.page_title(F.col("html")).alias("title"),
        F.parse_url(F.col("url"), F.lit("HOST")).alias("press"),
        F.lit(None).cast("string").alias("sentiment"),
        F.lit(1).alias("ingest_seq"),
    )
    return as_changes(labelled(spark, sf_dir, how="inner")).unionByName(fresh)


def existing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).select(
        "url", "title", "press", "category", "published_at", F.lit(None).cast("string").alias("sentiment")
    )
