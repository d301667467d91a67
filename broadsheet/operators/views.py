"""Counts kept beside a keyed table: what a batch replaces is subtracted, what it brings is added.

A view is a set of partial counts that add up: a folder of signed counts per batch, on top of a
compacted base that has taken in all batches up to its mark. Reading sums them. Counts per hour
serve every window and interval whose ends fall on full hours.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.functions import times as TM
from broadsheet.operators import store
from broadsheet.schemas import SENTIMENT_LABELS
from broadsheet.session import file_system
from broadsheet.sources.keyed import NO_MARK, KeyedTable

Facts = Callable[[DataFrame], DataFrame]


def article_facts(rows: DataFrame) -> DataFrame:
    """One row per article: its hour, category and label."""
    return rows.select(F.date_trunc("hour", "published_at").cast("timestamp_ntz").alias("hour"), "category", S.label_of().alias("label"))


def keyword_facts(rows: DataFrame) -> DataFrame:
    """One row per keyword of an article: the hour it was processed, category, keyword."""
    hour = F.date_trunc("hour", "processed_at").cast("timestamp_ntz").alias("hour")
    return rows.select(hour, "category", F.explode("keywords").alias("keyword")).where("keyword <> ''")


VIEWS: dict[str, Facts] = {"articles": article_facts, "keywords": keyword_facts}


def signed(before: DataFrame, after: DataFrame, facts: Facts) -> DataFrame:
    """Change of every count when the rows ``before`` become the rows ``after``."""
    old = facts(before).withColumn("n", F.lit(-1))
    both = facts(after).withColumn("n", F.lit(1)).unionByName(old)
    keys = [c for c in both.columns if c != "n"]
    return both.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def apply_batch(
    table: KeyedTable, incoming: DataFrame, order: str, batch_id: int, path: str, views: dict[str, Facts] = VIEWS
) -> None:
    """Take a batch into the table and its views.

    The signed counts are written first, from the table as it was before the batch; the table's
    commit with the batch's mark comes last. A batch that died in between is counted again from the
    same state and replaces its folders; one that the mark covers changes nothing. The batch's
    newest rows are computed once and stored until the commit: counts and table all read them.
    """
    if table.exists() and table.mark() >= batch_id:
        return
    staged = f"{path}/incoming/batch_id={batch_id}"
    store.latest_per_key(incoming, table.key, order).write.mode("overwrite").parquet(staged)
    newest = incoming.sparkSession.read.schema(incoming.schema).parquet(staged)
    if table.exists():
        before = table.read().join(newest.select(table.key), table.key, "left_semi")
    else:
        before = newest.limit(0).drop(order)
    for name, facts in views.items():
        delta = signed(before, newest, facts)
        delta.write.mode("overwrite").parquet(f"{path}/{name}/deltas/batch_id={batch_id}")
    if table.exists():
        table.upsert(newest, order, mark=batch_id)
    else:
        table.create(newest.drop(order), mark=batch_id)
    fs, done = file_system(incoming.sparkSession, staged)
    fs.delete(done, True)


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    fs, path = file_system(spark, folder)
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith(prefix)]
    return sorted(int(p.getName()[len(prefix) :]) for p in found if fs.exists(p.suffix("/_SUCCESS")))


def _parts(spark: SparkSession, path: str, name: str, up_to: int | None = None) -> tuple[list[str], int]:
    bases = _numbers(spark, f"{path}/{name}/base", "mark=")
    mark = bases[-1] if bases else NO_MARK
    deltas = [b for b in _numbers(spark, f"{path}/{name}/deltas", "batch_id=") if b > mark and (up_to is None or b <= up_to)]
    folders = [f"{path}/{name}/base/mark={mark}"] if bases else []
    return folders + [f"{path}/{name}/deltas/batch_id={b}" for b in deltas], max([mark, *deltas])


def counts(spark: SparkSession, path: str, name: str, up_to: int | None = None) -> DataFrame:
    """The view as of batch ``up_to``: give the table's mark to leave out a batch not yet committed."""
    folders, _ = _parts(spark, path, name, up_to)
    if not folders:
        raise ValueError(f"no batch of {name} yet")
    rows = spark.read.parquet(*folders)
    keys = [c for c in rows.columns if c != "n"]
    return rows.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def compact(spark: SparkSession, path: str, table: KeyedTable, views: dict[str, Facts] = VIEWS) -> None:
    """Fold the deltas of committed batches into a new base, then remove what it took in."""
    for name in views:
        folders, mark = _parts(spark, path, name, table.mark())
        if len(folders) > 1 or (folders and "/deltas/" in folders[0]):
            counts(spark, path, name, table.mark()).write.mode("overwrite").parquet(f"{path}/{name}/base/mark={mark}")
            for folder in folders:
                fs, gone = file_system(spark, folder)
                fs.delete(gone, True)


# --- answers from the counts -----------------------------------------------------


def within(rows: DataFrame, as_of, days: int, category: str | None = None) -> DataFrame:
    """Hours from ``as_of - days`` up to, not including, ``as_of``; both on full hours."""
    rows = rows.where((F.col("hour") >= TM.moment(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col("hour") < TM.moment(as_of)))
    return rows.where(F.col("category") == category) if category else rows


def timeline(
    articles: DataFrame, as_of, interval: str = "day", days: int = 30, category: str | None = None, sentiment: str | None = None
) -> DataFrame:
    rows = within(articles, as_of, days, category)
    rows = rows.where(F.col("label") == sentiment) if sentiment else rows
    return rows.groupBy(TM.bucket(F.col("hour"), interval).alias("bucket")).agg(F.sum("n").alias("count")).orderBy("bucket")


def distribution(articles: DataFrame, as_of, days: int = 7, category: str | None = None) -> DataFrame:
    """One row with a zero-filled count per label."""
    rows = within(articles, as_of, days, category)
    return rows.agg(
        *[F.coalesce(F.sum(F.when(F.col("label") == x, F.col("n"))), F.lit(0)).alias(x) for x in SENTIMENT_LABELS]
    )


def trending(keywords: DataFrame, as_of, category: str | None = None, days: int = 7, limit: int = 20) -> DataFrame:
    rows = within(keywords, as_of, days, category).groupBy("keyword").agg(F.sum("n").alias("count"))
    return rows.orderBy(F.desc("count"), F.asc("keyword")).limit(limit)
