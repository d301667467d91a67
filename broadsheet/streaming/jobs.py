"""Structured Streaming jobs. They call the same transforms as the batch queries.

Every job keeps its own checkpoint, so a lost executor or a restart resumes where the
last committed batch ended. Sinks are either the exactly-once file sink, or folders named
by batch id that a repeated batch overwrites.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from broadsheet.functions import sentiment as S
from broadsheet.functions import topics as TP
from broadsheet.operators import enrich, ledger, models, sink, store
from broadsheet.schemas import BATCH_ERROR_MODEL_NAME, STAGES
from broadsheet.session import file_system
from broadsheet.sources import messages as M


def read_table_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files of one table, a folder of part files or a single file.

    The schema is read from the files. A stream reads folders only, so a single file is
    picked by its name from the folder it lies in.
    """
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    reader = spark.readStream.schema(table.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    fs, path = file_system(spark, f"{folder}/{name}.parquet")
    if fs.getFileStatus(path).isFile():
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(f"{folder}/{name}.parquet")


def read_folder_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run continuously every ``every``, or once over what is there when it is None."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    start(writer, checkpoint).awaitTermination()


def stop_when_idle(query: StreamingQuery, idle_seconds: float, poll_seconds: float = 1.0) -> None:
    """Stop after ``idle_seconds`` without input; 0 never stops."""
    last_input = time.monotonic()
    seen = None
    while query.isActive:
        progress = query.lastProgress
        if progress and progress["batchId"] != seen:
            seen = progress["batchId"]
            if progress["numInputRows"] > 0:
                last_input = time.monotonic()
        if idle_seconds > 0 and time.monotonic() - last_input > idle_seconds:
            query.stop()
            return
        time.sleep(poll_seconds)


def to_files(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Exactly-once file sink, run once."""
    writer = df.writeStream.format(fmt).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    drain(writer, checkpoint)


def batch_folders(path: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df):
    """foreachBatch writer: one folder per batch id, replaced when a batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


# --- enrichment ------------------------------------------------------------


def text_job(messages: DataFrame, as_of, path: str, checkpoint: str, stopwords: Sequence[str] = (), tasks: int | None = None) -> None:
    """Raw messages to processed articles; refused messages go to their own folder.

    One pass over the stream: the ``outcome`` partition keeps both outputs apart. Give
    ``tasks`` when the source has fewer partitions than the job has cores; a Kafka source
    splits its partitions by ``minPartitions`` instead. Counters per batch are observed
    under ``text_job`` in the query progress.
    """
    checked = M.checked(messages.repartition(tasks, "offset") if tasks else messages)
    ok = F.col("reject_reason").isNull()
    record = F.col("record")
    articles = checked.select(
        "offset",
        "topic",
        "reject_reason",
        F.when(ok, "processed").otherwise("rejected").alias("outcome"),
        F.when(~ok, F.col("value")).alias("value"),
        *[F.when(ok, record[c]).alias(c) for c in ("title", "content", "url", "press", "published_at")],
        M.category_or_topic(record["category"], F.col("topic")).alias("category"),
    )
    staged = enrich.text_stage(articles, as_of, stopwords=stopwords)
    counters = [F.count(F.lit(1)).alias("messages"), F.count_if(F.col("outcome") == "rejected").alias("rejected")]
    to_files(staged.observe("text_job", *counters), path, checkpoint, ["outcome"])


def summary_job(
    messages: DataFrame,
    summarise: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    categories: Sequence[str] | None = None,
) -> None:
    """Processed messages of the known categories to summary records with the topic they go to.

    ``summarise`` attaches ``summary_info`` and its time, see ``enrich``. Messages that are refused
    and rows whose summary failed are kept under their own ``outcome``.
    """
    named = M.by_topics(messages, TP.topic_list("processed", categories))
    checked = M.checked(named)
    good = F.col("reject_reason").isNull()
    fields = ("title", "content", "url", "press", "published_at", "keywords")
    articles = checked.select(
        "topic",
        "offset",
        "reject_reason",
        F.when(~good, F.col("value")).alias("value"),
        *[F.when(good, F.col(f"record.{c}")).alias(c) for c in fields],
        M.category_or_topic(F.col("record.category"), F.col("topic")).alias("category"),
    )
    made = summarise(articles)
    failed = F.col("summary_info.model_info.name") == BATCH_ERROR_MODEL_NAME
    outcome = F.when(~good, "rejected").when(failed, "failed").otherwise("summary")
    target = TP.topic_name(TP.category_between(F.col("topic"), "processed"), "summary")
    to_files(made.withColumns({"outcome": outcome, "target_topic": target}), path, checkpoint, ["outcome"])


def sentiment_job(articles: DataFrame, models_folder: str, path: str, checkpoint: str, as_of) -> None:
    """Score articles with the newest stored model; nothing is trained here."""
    model = models.latest(articles.sparkSession, models_folder)
    to_files(models.analyse_sentiment(articles, model, as_of), path, checkpoint)


def fan_out(messages: DataFrame, jobs: dict[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str) -> None:
    """Independent queries over one stream, each with its own sink and checkpoint."""
    running = [
        start(
            job(messages).writeStream.format("parquet").option("path", f"{path}/{name}"),
            f"{checkpoint}/{name}",
        )
        for name, job in jobs.items()
    ]
    for query in running:
        query.awaitTermination()


def archive_job(messages: DataFrame, path: str, checkpoint: str) -> None:
    """Raw messages as JSON files under one folder per category."""
    named = messages.withColumn("category", TP.topic_part(F.col("topic"), 1))
    to_files(named, path, checkpoint, ["category"], fmt="json")


def sink_job(
    messages: DataFrame, path: str, checkpoint: str, as_of, stages: Sequence[str] = STAGES, fold_every: int = 10
) -> None:
    """Messages of all stages into the stage tables: every batch to the log, every ``fold_every``
    batches (and at the end) the log into the tables. Path and checkpoint belong together."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.log_batch(batch, batch_id, path, as_of, stages)
        if (batch_id + 1) % fold_every == 0:
            sink.fold(batch.sparkSession, path, stages)

    drain(messages.writeStream.foreachBatch(write), checkpoint)
    sink.fold(messages.sparkSession, path, stages)


def ledger_job(messages: DataFrame, path: str, checkpoint: str) -> None:
    """Messages with topic, partition and offset into the archive with its ledger; a stream that
    starts anew over the same topics stores nothing twice."""
    drain(messages.writeStream.foreachBatch(lambda batch, _: ledger.archive(batch, path)), checkpoint)


# --- keyed sinks -----------------------------------------------------------


def upsert_job(changes: DataFrame, path: str, checkpoint: str, key: str = "url", order: str = "ingest_seq") -> None:
    """Append each batch's latest record per key to the change log (the speed view).

    The big table is not rewritten per batch: ``latest_changes`` reads the log and
    ``store.upsert_merge`` folds it into the table whenever the table is rebuilt.
    """
    write = batch_folders(path, lambda batch: store.latest_per_key(batch, key, order))
    drain(changes.writeStream.foreachBatch(write), checkpoint)


def read_log(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All batch folders of a log; with a ``schema`` a log without any batch is an empty table."""
    fs, folder = file_system(spark, path)
    if schema and not (fs.exists(folder) and len(fs.listStatus(folder))):
        return spark.createDataFrame([], f"{schema}, batch_id int")
    return spark.read.parquet(path)


def latest_changes(
    spark: SparkSession, path: str, key: str = "url", order: str = "ingest_seq", schema: str | None = None
) -> DataFrame:
    """Newest record per key of the change log; a later batch wins."""
    log = read_log(spark, path, schema)
    ranked = log.withColumn(order, F.struct("batch_id", order))
    newest = store.latest_per_key(ranked, key, order)
    return newest.withColumn(order, F.col(f"{order}.{order}")).drop("batch_id")


def dedup(stream: DataFrame, key: str, event_time: str, delay: str, spread_by: Column, ways: int = 16) -> DataFrame:
    """First record per key within the watermark delay.

    Copies are thinned twice: first per key and a spreading number, so a key holding a
    large share of the stream is handled by ``ways`` tasks, then per key.
    """
    timed = stream.withColumn("_time", F.col(event_time).cast("timestamp")).withWatermark("_time", delay)
    thinned = timed.withColumn("_way", F.pmod(spread_by, F.lit(ways))).dropDuplicatesWithinWatermark([key, "_way"])
    return thinned.drop("_way").dropDuplicatesWithinWatermark([key]).drop("_time")


# --- running counts --------------------------------------------------------


def keep_latest(counts: DataFrame, path: str, checkpoint: str) -> None:
    """Write the changed groups of every batch (update mode) to its own folder."""
    drain(counts.writeStream.outputMode("update").foreachBatch(batch_folders(path)), checkpoint)


def latest_counts(
    spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str], schema: str | None = None
) -> DataFrame:
    """The last state of every group."""
    log = read_log(spark, path, schema)
    newest = F.max(F.struct("batch_id", *values)).alias("_last")
    return log.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])


def topic_counters(messages: DataFrame) -> DataFrame:
    """Running message count per topic; counts combine map-side, so a hot topic is cheap."""
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("count"))


def live_timeline(articles: DataFrame, delay: str, size: str = "1 day") -> DataFrame:
    timed = articles.withColumn("_time", F.col("published_at").cast("timestamp")).withWatermark("_time", delay)
    counted = timed.groupBy(F.window("_time", size)).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(F.col("window.start").cast("timestamp_ntz").alias("bucket_start"), "count")


def live_sentiment(articles: DataFrame, delay: str, size: str = "1 day") -> DataFrame:
    timed = (
        articles.where(S.label_of().isNotNull())
        .withColumn("_time", F.col("published_at").cast("timestamp"))
        .withWatermark("_time", delay)
    )
    counted = timed.groupBy(F.window("_time", size)).agg(*S.label_counts(S.label_of()), F.count(F.lit(1)).alias("total"))
    return counted.select(F.col("window.start").cast("timestamp_ntz").alias("bucket_start"), "negative", "neutral", "positive", "total")


def live_trending(keywords: DataFrame, delay: str, size: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Keyword counts of sliding windows from rows of (at, keyword, n).

    ``n`` is 1 for a keyword of an article, -1 where a correction takes it back, so a correction
    that comes within ``delay`` changes the windows that held the old keywords. Counts combine
    map-side, so a very common keyword is a few rows per task.
    """
    timed = keywords.withColumn("_time", F.col("at").cast("timestamp")).withWatermark("_time", delay)
    counted = timed.groupBy(F.window("_time", size, slide), "keyword").agg(F.sum("n").alias("count"))
    return counted.select(F.col("window.end").cast("timestamp_ntz").alias("window_end"), "keyword", "count")


def top_keywords(counts: DataFrame, limit: int = 10) -> DataFrame:
    """The most frequent keywords of every window, with their rank."""
    window = Window.partitionBy("window_end").orderBy(F.desc("count"), F.asc("keyword"))
    ranked = counts.where("count > 0").withColumn("rank", F.row_number().over(window))
    return ranked.where(F.col("rank") <= limit)
