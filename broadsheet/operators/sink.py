"""The sink: messages of all stages into one table per stage, the newest record per url.

A batch goes to a change log, one folder per batch id that a repeated batch replaces. Folding
takes the batches after a table's mark into that table and moves the mark with the same commit, so
a batch is taken in once: a fold that is repeated, or that died before it cleaned the log, finds
nothing new. Between two folds, ``current`` reads table and log as one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.functions import times as TM
from broadsheet.functions import topics as TP
from broadsheet.operators import store
from broadsheet.schemas import SENTIMENT_ANALYSIS, STAGE_COLUMNS, STAGE_TABLES, STAGED_ARTICLE, STAGES
from broadsheet.session import file_system
from broadsheet.sources import messages as M
from broadsheet.sources.keyed import NO_MARK, KeyedTable

REJECTED = "rejected"
TABLE_STAGE = {table: stage for stage, table in STAGE_TABLES.items()}


def stage_of(topic: Column, stages: Sequence[str]) -> Column:
    """Stage named by a sink topic; NULL for other topics and stages not asked for."""
    named = F.regexp_extract(topic, rf"^news\.[a-zA-Z0-9_-]+\.({'|'.join(stages)})$", 1)
    return F.when(named != "", named)


def records(messages: DataFrame, as_of, stages: Sequence[str] = STAGES, order: str = "offset") -> DataFrame:
    """Typed records of sink messages with their table; refused ones with their reason.

    Columns: table_name (``rejected`` for a refused message), topic, the order column,
    reject_reason, value (of refused ones), and all stages' columns, null where a stage has none. A
    stage's own time and the collection time become ``as_of`` where a message lacks them.
    """
    sent = messages.withColumn("stage", stage_of(F.col("topic"), stages)).where("stage IS NOT NULL")
    checked = M.decode(sent, STAGED_ARTICLE)
    r = F.col("record")
    summary = F.coalesce(r["summary_info"]["summary"], r["summary"])
    reason = F.coalesce(
        M.reject_reason(), F.when((F.col("stage") == "summary") & summary.isNull(), "missing summary")
    )
    later = F.col("stage") != "raw"
    wire = r["sentiment_analysis"]
    nested = F.when(
        wire["overall_sentiment"].isNotNull() | wire["error"].isNotNull(),
        F.struct(wire["overall_sentiment"].alias("overall_sentiment"), wire["error"].alias("error")),
    )

    def at(name: str, applies: Column) -> Column:
        return F.when(applies, F.coalesce(TM.parse_iso(r[name]), TM.moment(as_of)))

    fields = {
        **{c: r[c] for c in ("url", "title", "content", "press", "keywords")},
        "category": M.category_or_topic(r["category"], F.col("topic")),
        "published_at": TM.parse_iso(r["published_at"]),
        "collected_at": at("collected_at", F.lit(True)),
        "processed_at": at("processed_at", later),
        "sentiment_analysis": S.nested_form(wire["sentiment"], wire["scores"], nested.cast(SENTIMENT_ANALYSIS)),
        "sentiment_processed_at": at("sentiment_processed_at", F.col("stage") == "sentiment"),
        "summary": summary,
        "processed_content": F.when(F.col("stage") == "summary", F.coalesce(r["processed_content"], r["content"])),
        "summary_processed_at": at("summary_processed_at", F.col("stage") == "summary"),
    }
    table = F.element_at(F.create_map(*[F.lit(x) for kv in STAGE_TABLES.items() for x in kv]), F.col("stage"))
    judged = checked.withColumn("reject_reason", reason)
    good = F.col("reject_reason").isNull()
    return judged.select(
        F.when(good, table).otherwise(REJECTED).alias("table_name"),
        "topic",
        order,
        "reject_reason",
        F.when(~good, F.col("value")).alias("value"),
        *[F.when(good, v).alias(c) for c, v in fields.items()],
    )


# --- change log --------------------------------------------------------------


def log_batch(batch: DataFrame, batch_id: int, path: str, as_of, stages: Sequence[str] = STAGES, order: str = "offset") -> None:
    """One batch of messages into the log: its newest record per table and url, and all refused.

    Everything is written in one pass; refused messages are no keys and stay each a row.
    """
    found = records(batch, as_of, stages, order)
    key = F.when(F.col("table_name") == REJECTED, F.concat_ws(" ", "topic", order)).otherwise(F.col("url"))
    keyed = found.withColumn("_key", F.struct("table_name", key.alias("k")))
    newest = store.latest_per_key(keyed, "_key", order).drop("_key")
    newest.write.mode("overwrite").partitionBy("table_name").parquet(f"{path}/log/batch_id={batch_id}")


def logged_batches(spark: SparkSession, path: str) -> list[int]:
    """Finished batches of the log."""
    fs, log = file_system(spark, f"{path}/log")
    if not fs.exists(log):
        return []
    folders = [s.getPath() for s in fs.listStatus(log) if s.getPath().getName().startswith("batch_id=")]
    return sorted(int(p.getName().split("=")[1]) for p in folders if fs.exists(p.suffix("/_SUCCESS")))


def log_rows(spark: SparkSession, path: str, table: str, batches: Sequence[int], order: str = "offset") -> DataFrame | None:
    """A table's rows in some batches of the log, ``_order`` being batch and place; None without any."""
    fs, _ = file_system(spark, path)
    folders = [f"{path}/log/batch_id={b}/table_name={table}" for b in batches]
    folders = [f for f in folders if fs.exists(file_system(spark, f)[1])]
    if not folders:
        return None
    rows = spark.read.option("basePath", f"{path}/log").parquet(*folders)
    return rows.withColumn("_order", F.struct(F.col("batch_id").cast("long").alias("batch_id"), order))


def rejected(spark: SparkSession, path: str) -> DataFrame | None:
    """Refused messages of all batches; folding leaves them where they are."""
    rows = log_rows(spark, path, REJECTED, logged_batches(spark, path))
    return None if rows is None else rows.select("topic", "offset", "reject_reason", "value")


# --- tables ------------------------------------------------------------------


def table_of(spark: SparkSession, path: str, table: str) -> KeyedTable:
    return KeyedTable(spark, f"{path}/tables/{table}", partition_by=["category"])


def fold(spark: SparkSession, path: str, stages: Sequence[str] = STAGES, order: str = "offset") -> dict[str, int]:
    """Take the log's new batches into the tables, then clear what all tables have taken in.

    Returns the number of urls that came into each table.
    """
    batches, came = logged_batches(spark, path), {}
    for stage in stages:
        name = STAGE_TABLES[stage]
        table = table_of(spark, path, name)
        fresh = [b for b in batches if b > table.mark()]
        rows = log_rows(spark, path, name, fresh, order)
        came[name] = 0
        if rows is None:
            continue
        columns = [F.col(c) for c in STAGE_COLUMNS[stage]]
        if table.exists():
            came[name] = table.upsert(rows.select(*columns, "_order"), "_order", mark=fresh[-1])
        else:
            newest = store.latest_per_key(rows.select(*columns, "_order"), "url", "_order").drop("_order")
            table.create(newest, mark=fresh[-1])
            came[name] = sum(r.n_rows for r in table.live().collect())
    clear_log(spark, path, stages)
    return came


def clear_log(spark: SparkSession, path: str, stages: Sequence[str] = STAGES) -> None:
    """Remove each table's folders up to its mark; refused messages stay."""
    for stage in stages:
        name = STAGE_TABLES[stage]
        mark = table_of(spark, path, name).mark()
        for batch in [b for b in logged_batches(spark, path) if b <= mark]:
            fs, folder = file_system(spark, f"{path}/log/batch_id={batch}/table_name={name}")
            fs.delete(folder, True)


def current(spark: SparkSession, path: str, table: str, order: str = "offset") -> DataFrame:
    """Batch view and speed view of one table: its rows and the log after its mark."""
    stored, columns = table_of(spark, path, table), STAGE_COLUMNS[TABLE_STAGE[table]]
    mark = stored.mark()
    rows = log_rows(spark, path, table, [b for b in logged_batches(spark, path) if b > mark], order)
    lowest = F.struct(F.lit(NO_MARK).cast("long").alias("batch_id"), F.lit(None).cast("long").alias(order))
    if rows is None:
        if not stored.exists():
            raise ValueError(f"no record of {table} yet")
        return stored.read().select(*columns)
    speed = rows.select(*columns, "_order")
    if not stored.exists():
        return store.latest_per_key(speed, "url", "_order").drop("_order")
    batch = stored.read().select(*columns, lowest.alias("_order"))
    return store.serving_view(batch, speed, "url", "_order").drop("_order")
