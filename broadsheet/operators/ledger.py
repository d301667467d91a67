"""The archive's ledger: which offsets of which topic partition are stored.

A run stores the messages whose offsets no finished run has covered, as JSON in folders by category,
and then writes its own ranges; only folders that the ledger names count as archived. So a
rerun, an overlapping replay or a run after a crash stores every message once.

A source delivers each topic partition in offset order without leaving any out, so what one run
stored of a partition covers everything between its first and last offset.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions import topics as TP
from broadsheet.session import file_system

MESSAGE = "topic string, value string, partition int, offset long"
RANGE = "topic string, partition int, first long, last long, n_messages long, attempt string"


def finished(spark: SparkSession, path: str) -> DataFrame:
    """The ranges of all finished runs."""
    fs, folder = file_system(spark, f"{path}/ledger")
    done = []
    if fs.exists(folder):
        done = [s.getPath() for s in fs.listStatus(folder) if fs.exists(s.getPath().suffix("/_SUCCESS"))]
    if not done:
        return spark.createDataFrame([], RANGE)
    return spark.read.schema(RANGE).parquet(*[p.toString() for p in done])


def covered(spark: SparkSession, path: str) -> DataFrame:
    """Disjoint covered ranges per topic partition: ranges that touch or overlap become one."""
    window = Window.partitionBy("topic", "partition").orderBy("first", "last")
    before = F.max("last").over(window.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") <= before + 1, 0).otherwise(1)
    island = F.sum("opens").over(window.rowsBetween(Window.unboundedPreceding, 0))
    named = finished(spark, path).withColumn("opens", opens).withColumn("island", island)
    return named.groupBy("topic", "partition", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def pending(messages: DataFrame, path: str) -> DataFrame:
    """Messages that no finished run has covered. One row of ranges per topic partition is joined,
    so the join multiplies nothing."""
    ranges = covered(messages.sparkSession, path).groupBy("topic", "partition").agg(
        F.collect_list(F.struct("first", "last")).alias("ranges")
    )
    told = messages.join(ranges, ["topic", "partition"], "left")
    held = F.exists("ranges", lambda r: F.col("offset").between(r["first"], r["last"]))
    return told.where(~F.coalesce(held, F.lit(False))).drop("ranges")


def archive(messages: DataFrame, path: str, rows_per_file: int = 100_000) -> int:
    """Store what is new of (topic, partition, offset, value); returns the number of messages.

    The ranges are read back from what was written. A run that finds nothing new writes no ledger.
    """
    spark, attempt = messages.sparkSession, uuid.uuid4().hex
    folder = f"{path}/data/attempt={attempt}"
    new = pending(messages.select("topic", "value", "partition", "offset"), path)
    (
        new.withColumn("category", TP.topic_part(F.col("topic"), 1))
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy("category")
        .json(folder)
    )
    stored = spark.read.schema("topic string, partition int, offset long").json(folder)
    ranges = stored.groupBy("topic", "partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("n_messages")
    )
    rows = ranges.withColumn("attempt", F.lit(attempt)).coalesce(1)
    rows.write.parquet(f"{path}/ledger/{attempt}")
    written = spark.read.schema(RANGE).parquet(f"{path}/ledger/{attempt}").agg(F.sum("n_messages")).first()[0] or 0
    if not written:
        for part in (f"{path}/ledger/{attempt}", folder):
            fs, gone = file_system(spark, part)
            fs.delete(gone, True)
    return written


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All archived messages with their category; folders of unfinished runs are not read."""
    attempts = [r.attempt for r in finished(spark, path).select("attempt").distinct().collect()]
    if not attempts:
        return spark.createDataFrame([], f"{MESSAGE}, category string")
    reader = spark.read.schema(f"{MESSAGE}, category string, attempt string").option("basePath", f"{path}/data")
    return reader.json([f"{path}/data/attempt={a}" for a in attempts]).drop("attempt")
