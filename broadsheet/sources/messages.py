"""Message sources: Kafka options, topic selection, JSON decoding and validation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions import times as TM
from broadsheet.functions import topics as TP
from broadsheet.functions.text import compute_once
from broadsheet.schemas import RAW_ARTICLE, REQUIRED_FIELDS

CORRUPT = "_corrupt_record"


def kafka_options(
    servers: str,
    topics: Iterable[str] | None = None,
    pattern: str | None = None,
    start: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Reader options for an explicit topic list or a topic pattern.

    Offsets that are gone fail the query unless ``fail_on_data_loss`` is off.
    """
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or a pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": start, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if pattern is not None:
        options["subscribePattern"] = pattern
    else:
        options["subscribe"] = ",".join(topics)
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka(spark: SparkSession, streaming: bool = True, **kwargs) -> DataFrame:
    """Topic and value of a Kafka source; a batch read replays from the earliest offset."""
    if not streaming:
        kwargs["start"] = "earliest"
        kwargs.pop("max_offsets_per_trigger", None)
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    frame = reader.options(**kafka_options(**kwargs)).load()
    return frame.select("topic", F.col("value").cast("string").alias("value"), "offset", "timestamp")


def write_kafka(df: DataFrame, servers: str, checkpoint: str, value_columns: Iterable[str]):
    """Stream writer that sends each row as JSON to the topic in its ``topic`` column."""
    out = df.select("topic", F.to_json(F.struct(*value_columns)).alias("value"))
    return (
        out.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )


def by_pattern(messages: DataFrame, pattern: str) -> DataFrame:
    return messages.where(F.col("topic").rlike(pattern))


def by_topics(messages: DataFrame, topics: Iterable[str]) -> DataFrame:
    return messages.where(F.col("topic").isin(list(topics)))


def decode(messages: DataFrame, schema: T.StructType = RAW_ARTICLE) -> DataFrame:
    """Message columns plus ``record``; text that is no valid JSON fills the corrupt field."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return compute_once(messages, "record", parsed)


def reject_reason(record: str = "record") -> Column:
    """NULL for a valid article, else why it is refused. The first failed check counts.

    A category that the record lacks is taken from its topic first; a missing
    ``collected_at`` is filled by the stage's stamp later.
    """
    reason = F.when(F.col(record).isNull() | F.col(f"{record}.{CORRUPT}").isNotNull(), "malformed json")
    for name in REQUIRED_FIELDS:
        value = F.col(f"{record}.{name}")
        if name == "category":
            value = category_or_topic(value, F.col("topic"))
        reason = reason.when(value.isNull(), f"missing {name}")
    for name in ("published_at", "collected_at"):
        value = F.col(f"{record}.{name}")
        reason = reason.when(value.isNotNull() & TM.parse_iso(value).isNull(), f"bad {name}")
    return reason.when(~F.col(f"{record}.url").rlike("^https?://"), "bad url")


def checked(messages: DataFrame) -> DataFrame:
    """Decoded messages with ``reject_reason``: one pass feeds both outputs."""
    return decode(messages).withColumn("reject_reason", reject_reason())


def accepted(checked_messages: DataFrame) -> DataFrame:
    """Typed article columns of the valid records."""
    ok = checked_messages.where(F.col("reject_reason").isNull())
    return ok.select(
        "topic",
        "offset",
        *[F.col(f"record.{n}").alias(n) for n in ("title", "content", "url", "press")],
        category_or_topic(F.col("record.category"), F.col("topic")).alias("category"),
        TM.parse_iso(F.col("record.published_at")).alias("published_at"),
        TM.parse_iso(F.col("record.collected_at")).alias("collected_at"),
        F.col("record.keywords").alias("keywords"),
    )


def rejected(checked_messages: DataFrame) -> DataFrame:
    return checked_messages.where(F.col("reject_reason").isNotNull()).select("topic", "offset", "value", "reject_reason")


def category_or_topic(category: Column, topic: Column) -> Column:
    """The record's own category, else the one named by the topic."""
    return F.coalesce(category, TP.topic_part(topic, 1))
