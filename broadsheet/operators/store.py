"""Reads and changes of keyed tables: find, count, upsert, update, delete, retention."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions import times as TM
from broadsheet.schemas import STAGE_RETENTION_DAYS, STAGE_TIME_COLUMN

SortKey = tuple[str, int]


def find_many(
    df: DataFrame,
    condition: Column | None = None,
    columns: Sequence[str] | None = None,
    sort: Sequence[SortKey] = (),
    skip: int = 0,
    limit: int = 0,
    tie_break: Sequence[str] = ("url",),
) -> DataFrame:
    """Filter, sort, page, project. ``limit`` 0 means all rows, ``skip`` 0 skips none.

    Missing values come first ascending and last descending. A page needs a total order,
    so ``tie_break`` columns follow the sort keys. Sort plus limit plans as a top-k: each
    task keeps ``skip + limit`` rows.
    """
    if condition is not None:
        df = df.where(condition)
    if sort or skip or limit:
        named = [name for name, _ in sort]
        order = [F.desc_nulls_last(n) if way < 0 else F.asc_nulls_first(n) for n, way in sort]
        df = df.orderBy(*order, *[F.asc(c) for c in tie_break if c not in named])
    if skip:
        df = df.offset(skip)
    if limit:
        df = df.limit(limit)
    return df.select(*columns) if columns else df


def find_one(df: DataFrame, condition: Column, columns: Sequence[str] | None = None) -> DataFrame:
    return find_many(df, condition, columns, limit=1)


def count_rows(df: DataFrame, condition: Column | None = None) -> DataFrame:
    df = df if condition is None else df.where(condition)
    return df.agg(F.count(F.lit(1)).alias("count"))


def newest_per_group(df: DataFrame, group: str, limit: int, skip: int = 0) -> DataFrame:
    """One page of the newest rows of every group, with their rank.

    The rank filter is pushed below the shuffle as a per-task group limit, so a group
    holding most rows still sends only ``skip + limit`` rows per task.
    """
    window = Window.partitionBy(group).orderBy(F.desc_nulls_last("published_at"), F.asc("url"))
    ranked = df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= skip + limit)
    return ranked.where(F.col("rank") > skip)


def has_map(kind: T.DataType) -> bool:
    """Whether a type is a map or holds one; such columns have no hash."""
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def latest_per_key(incoming: DataFrame, key: str = "url", order: str = "ingest_seq") -> DataFrame:
    """Last write per key. Keeping rank 1 is a per-task group limit before the shuffle, so
    a key with very many copies is thinned where it is read. Of writes with an equal
    ``order`` the one with the largest hash of its columns counts (maps by their JSON text)."""
    hashed = [F.to_json(f.name) if has_map(f.dataType) else F.col(f.name) for f in incoming.schema.fields]
    window = Window.partitionBy(key).orderBy(F.desc(order), F.desc(F.xxhash64(*hashed)))
    return incoming.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def upsert_merge(existing: DataFrame, incoming: DataFrame, key: str = "url", order: str = "ingest_seq") -> DataFrame:
    """Merge the latest incoming record of each key into the table.

    Columns the incoming side carries overwrite, nulls included; columns it does not
    carry keep the stored value. New keys are inserted. Both sides hold each key once
    after ``latest_per_key``, so no key can be hot.
    One full outer join updates and inserts.
    """
    carried = [c for c in incoming.columns if c not in (key, order)]
    packed = latest_per_key(incoming, key, order).select(key, F.struct(*carried).alias("_new"))

    def value(name: str) -> Column:
        if name not in carried:
            return F.col(name)
        stored = F.col(name) if name in existing.columns else F.lit(None)
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(stored).alias(name)

    columns = existing.columns + [c for c in carried if c not in existing.columns]
    out = [key] + [value(c) for c in columns if c != key]
    return existing.join(packed, key, "full_outer").select(*out)


def stamp(df: DataFrame, stage: str, as_of: str) -> DataFrame:
    """Give rows without the stage's timestamp the as-of time."""
    name = STAGE_TIME_COLUMN[stage]
    stored = F.col(name) if name in df.columns else F.lit(None).cast("timestamp_ntz")
    return df.withColumn(name, F.coalesce(stored, TM.moment(as_of)))


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """Conditional assignment; ``changed`` marks rows whose stored value really differs."""
    hit = F.coalesce(condition, F.lit(False))
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(v) for c, v in assignments.items()])
    new = {c: F.when(hit, v).otherwise(F.col(c)) for c, v in assignments.items()}
    return df.withColumns({**new, "changed": hit & differs})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that stay; a condition that is unknown deletes nothing."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def insert_many(df: DataFrame, rows: DataFrame) -> DataFrame:
    return df.unionByName(rows, allowMissingColumns=True)


def key_violations(df: DataFrame, key: str = "url") -> DataFrame:
    """Keys that occur more than once; counted with map-side combine."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def within_retention(df: DataFrame, stage: Column, at: Column, as_of: str) -> DataFrame:
    """Rows younger than their stage's retention; stages without one are kept."""
    days = F.lit(None).cast("int")
    for name, value in STAGE_RETENTION_DAYS.items():
        days = F.when(stage == name, F.lit(value)).otherwise(days)
    limit = TM.moment(as_of) - F.make_dt_interval(days)
    return df.where(F.coalesce(at >= limit, F.lit(True)))


def unprocessed(raw: DataFrame, processed: DataFrame, limit: int = 100) -> DataFrame:
    """Oldest collected raw articles without a processed record."""
    left = raw.join(processed.select("url"), "url", "left_anti")
    return left.orderBy(F.asc_nulls_first("collected_at"), F.asc("url")).limit(limit)


def stage_coverage(stages: dict[str, DataFrame], key: str = "url") -> DataFrame:
    """One row per key with a flag per stage table.

    The keys are stacked and grouped once instead of joining table after table, so the
    whole check is one shuffle with map-side combine.
    """
    parts = [
        df.select(key, *[F.lit(other == name).alias(other) for other in stages]) for name, df in stages.items()
    ]
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.groupBy(key).agg(*[F.bool_or(s).alias(s) for s in stages])


def union_sources(*frames: DataFrame) -> DataFrame:
    """Stack sections or collectors into one stream; duplicates stay until the upsert."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def serving_view(batch: DataFrame, speed: DataFrame, key: str = "url", order: str = "ingest_seq") -> DataFrame:
    """Batch view and speed view as one table, newest record per key."""
    return latest_per_key(batch.unionByName(speed, allowMissingColumns=True), key, order)
