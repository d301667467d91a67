"""Record types and the fixed dimensions of the article domain."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_ARTICLE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("press", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("collected_at", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
    ]
)
"""Wire form of a raw article: timestamps travel as ISO-8601 text."""

OVERALL_SENTIMENT = T.StructType(
    [
        T.StructField("sentiment", T.StringType()),
        T.StructField("scores", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

SENTIMENT_ANALYSIS = T.StructType(
    [
        T.StructField("overall_sentiment", OVERALL_SENTIMENT),
        T.StructField("error", T.StringType()),
    ]
)

SUMMARY_INFO = T.StructType(
    [
        T.StructField("summary", T.StringType()),
        T.StructField("original_length", T.LongType()),
        T.StructField("summary_length", T.LongType()),
        T.StructField("sentence_count", T.LongType()),
        T.StructField("compression_ratio", T.DoubleType()),
        T.StructField(
            "model_info",
            T.StructType(
                [T.StructField("name", T.StringType()), T.StructField("type", T.StringType())]
            ),
        ),
        T.StructField("processing_time_seconds", T.DoubleType()),
    ]
)

SENTIMENT_WIRE = T.StructType(
    [
        *SENTIMENT_ANALYSIS.fields,
        T.StructField("sentiment", T.StringType()),
        T.StructField("scores", T.MapType(T.StringType(), T.DoubleType())),
    ]
)
"""Both written shapes of the sentiment record: nested, or label and scores at its top."""

STAGED_ARTICLE = T.StructType(
    [
        *RAW_ARTICLE.fields,
        T.StructField("processed_at", T.StringType()),
        T.StructField("sentiment_analysis", SENTIMENT_WIRE),
        T.StructField("sentiment_processed_at", T.StringType()),
        T.StructField("summary_info", T.StructType([T.StructField("summary", T.StringType())])),
        T.StructField("summary", T.StringType()),
        T.StructField("processed_content", T.StringType()),
        T.StructField("summary_processed_at", T.StringType()),
    ]
)
"""Wire form of an article of any stage; each stage fills its own fields."""

REQUIRED_FIELDS = ("title", "content", "url", "press", "category", "published_at")

# ---------------------------------------------------------------------------
# They must equal the reference's, so they are listed as they are.
# ---------------------------------------------------------------------------

TOPIC_PREFIX = "news"

CATEGORIES = {
    "economy": "경제",
    "business": "기업",
    "society": "사회",
    "world": "국제",
    "politics": "정치",
    "it": "IT",
    "culture": "문화",
}

DEFAULT_CATEGORY_CODE = "100"

STAGES = ("raw", "processed", "sentiment", "summary")

STAGE_RETENTION_DAYS = {"raw": 7, "processed": 14, "sentiment": 30, "summary": 30}

STAGE_TABLES = {
    "raw": "news_articles",
    "processed": "processed_articles",
    "sentiment": "sentiment_articles",
    "summary": "summary_articles",
}

STAGE_TIME_COLUMN = {
    "raw": "collected_at",
    "processed": "processed_at",
    "sentiment": "sentiment_processed_at",
    "summary": "summary_processed_at",
}

# Columns of each stage's table: a stage adds to what the earlier ones store.
RAW_COLUMNS = ("url", "title", "content", "press", "category", "published_at", "collected_at", "keywords")
STAGE_COLUMNS = {
    "raw": RAW_COLUMNS,
    "processed": (*RAW_COLUMNS, "processed_at"),
    "sentiment": (*RAW_COLUMNS, "processed_at", "sentiment_analysis", "sentiment_processed_at"),
    "summary": (*RAW_COLUMNS, "processed_at", "summary", "processed_content", "summary_processed_at"),
}

SENTIMENT_LABELS = ("negative", "neutral", "positive")

MIN_TEXT_FOR_SUMMARY = 100
SUMMARY_MIN_LENGTH = 30
SUMMARY_MAX_LENGTH = 150
SKIPPED_MODEL_NAME = "N/A (skipped by processor)"
SKIPPED_MODEL_TYPE = "text too short, empty, or summarizer internal skip"
BATCH_ERROR_PREFIX = "Error during batch summarization: "
BATCH_ERROR_MODEL_NAME = "N/A (error in batch)"

# (site, section, category): one category may own several sections of one site.
SECTIONS = (
    ("mk", "economy", "economy"),
    ("mk", "stock", "economy"),
    ("mk", "realestate", "economy"),
    ("mk", "business", "business"),
    ("mk", "politics", "politics"),
    ("mk", "society", "society"),
    ("mk", "world", "world"),
    ("mk", "culture", "culture"),
    ("mk", "it", "it"),
    ("naver", "101", "economy"),
    ("naver", "105", "it"),
    ("naver", "102", "society"),
    ("naver", "100", "politics"),
    ("naver", "104", "world"),
    ("naver", "103", "culture"),
    ("hankyung", "economy", "economy"),
    ("hankyung", "society", "society"),
    ("hankyung", "international", "world"),
    ("hankyung", "politics", "politics"),
    ("hankyung", "it", "it"),
)
