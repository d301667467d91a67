"""Keyed article tables: Parquet files in key order, and commits that list the live ones.

A change writes new files beside the old ones and then one small commit: which files are live, how
many rows and which keys each holds, and a mark (the last batch that was taken in). A commit counts
once its _SUCCESS file is there, so a job that dies half-way leaves the table as it was, and
files that no commit names are removed by ``clean``. One writer per table at a time.

Files hold rows in key order with bloom filters on the key, so a lookup by key reads few row
groups. Only files that hold a changed row are read and rewritten. What comes to the driver are
file names, as for any Parquet table that Spark lists.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions import times as TM
from broadsheet.operators import store
from broadsheet.session import file_system

COMMIT = "file string, n_rows long, low string, high string, parts map<string,string>, mark long, schema string"
NO_MARK = -1


def tail(file: str) -> str:
    """A data file's path below the table's data folder."""
    return file.rsplit("/data/", 1)[1]


def tail_of(address: Column) -> Column:
    """The same from a row's file address, which is encoded as a URI is."""
    return F.url_decode(F.replace(F.substring_index(address, "/data/", -1), F.lit("+"), F.lit("%2B")))


class KeyedTable:
    """A table at ``path``, unique by ``key``, in folders by ``partition_by`` (none by default)."""

    def __init__(self, spark: SparkSession, path: str, key: str = "url", partition_by: Sequence[str] = ()):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.partition_by = list(partition_by)

    # --- commits -------------------------------------------------------------

    def _commits(self) -> list[int]:
        fs, path = file_system(self.spark, f"{self.path}/commits")
        if not fs.exists(path):
            return []
        names = [s.getPath() for s in fs.listStatus(path)]
        done = [p for p in names if fs.exists(p.suffix("/_SUCCESS"))]
        return sorted(int(p.getName()) for p in done)

    def _commit_rows(self, number: int) -> DataFrame:
        return self.spark.read.schema(COMMIT).parquet(f"{self.path}/commits/{number}")

    def live(self) -> DataFrame:
        """One row per live file: file, n_rows, low, high (its keys), parts (its partition)."""
        commits = self._commits()
        rows = self._commit_rows(commits[-1]) if commits else self.spark.createDataFrame([], COMMIT)
        return rows.where(F.col("file").isNotNull())

    def _header(self):
        commits = self._commits()
        return self._commit_rows(commits[-1]).where(F.col("file").isNull()).first() if commits else None

    def exists(self) -> bool:
        return bool(self._commits())

    def mark(self) -> int:
        """The last batch whose rows are in the table."""
        header = self._header()
        return header.mark if header else NO_MARK

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._header().schema))

    def _commit(self, live: DataFrame, schema: T.StructType, mark: int) -> None:
        number = (self._commits() or [0])[-1] + 1
        header = self.spark.createDataFrame([(None, None, None, None, None, mark, schema.json())], COMMIT)
        named = live.select("file", "n_rows", "low", "high", "parts").withColumns(
            {"mark": F.lit(None).cast("long"), "schema": F.lit(None).cast("string")}
        )
        # What an unfinished commit of that number left behind is overwritten.
        named.unionByName(header).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{number}")

    def clean(self, keep: int = 1) -> int:
        """Remove commits before the last ``keep`` and files that the kept ones do not name."""
        fs, data = file_system(self.spark, f"{self.path}/data")
        commits = self._commits()
        for number in commits[: max(len(commits) - keep, 0)]:
            fs.delete(file_system(self.spark, f"{self.path}/commits/{number}")[1], True)
        named = set()
        for number in commits[-keep:]:
            named |= {tail(r.file) for r in self._commit_rows(number).where("file IS NOT NULL").collect()}
        removed = 0
        if fs.exists(data):
            found = fs.listFiles(data, True)
            while found.hasNext():
                file = found.next().getPath()
                if file.getName().endswith(".parquet") and tail(file.toString()) not in named:
                    removed += bool(fs.delete(file, False))
        return removed

    # --- reading -------------------------------------------------------------

    def _files(self, files: Sequence[str], schema: T.StructType, named: bool = False) -> DataFrame:
        """Rows of the files; ``named`` adds the address of each row's file as ``_file``."""
        if not files:
            rows = self.spark.createDataFrame([], schema)
            return rows.withColumn("_file", F.lit(None).cast("string")) if named else rows
        reader = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("attempt", T.StringType())]))
        rows = reader.option("basePath", f"{self.path}/data").parquet(*files)
        file = [F.col("_metadata.file_path").alias("_file")] if named else []
        return rows.select(*schema.names, *file)

    def read(self, live: DataFrame | None = None, named: bool = False) -> DataFrame:
        """All rows, or those of some live files."""
        live = self.live() if live is None else live
        return self._files([r.file for r in live.select("file").collect()], self.schema(), named)

    def lookup(self, key: str) -> DataFrame:
        """The row of one key: files whose key range cannot hold it are not opened."""
        live = self.live().where(F.lit(key).between(F.col("low"), F.col("high")))
        return self.read(live).where(F.col(self.key) == key)

    # --- writing -------------------------------------------------------------

    def _written(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """Write the rows and list the new files. Row order decides the key ranges."""
        folder = f"{self.path}/data/attempt={uuid.uuid4().hex}"
        writer = df.select(*schema.names).write.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
        writer.partitionBy(*self.partition_by).parquet(folder)
        return self._listed(folder, schema)

    def _listed(self, folder: str, schema: T.StructType) -> DataFrame:
        fs, path = file_system(self.spark, folder)
        found, files = fs.listFiles(path, True), []
        while found.hasNext():
            file = found.next().getPath()
            if file.getName().endswith(".parquet"):
                files.append(file.toString())
        if not files:
            return self.spark.createDataFrame([], COMMIT)
        parts = [x for c in self.partition_by for x in (F.lit(c), F.first(F.col(c).cast("string")))]
        by_file = self._files(files, schema, named=True).groupBy(tail_of(F.col("_file")).alias("name"))
        counted = by_file.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(self.key).alias("low"),
            F.max(self.key).alias("high"),
            (F.create_map(*parts) if parts else F.create_map().cast("map<string,string>")).alias("parts"),
        )
        paths = self.spark.createDataFrame([(f, tail(f)) for f in files], "file string, name string")
        return counted.join(paths, "name")

    def _in_key_order(self, df: DataFrame) -> DataFrame:
        return df.repartitionByRange(self.key).sortWithinPartitions(*self.partition_by, self.key)

    def create(self, df: DataFrame, mark: int = NO_MARK) -> KeyedTable:
        """The first commit, or a new start. Keys must be unique and not null."""
        bad = store.key_violations(df, self.key).unionByName(
            df.where(F.col(self.key).isNull()).select(self.key, F.lit(1).cast("long").alias("copies"))
        )
        if not bad.isEmpty():
            raise ValueError(f"{self.key} must be unique and not null")
        self._commit(self._written(self._in_key_order(df), df.schema), df.schema, mark)
        return self

    def _replace(self, touched: Sequence[str], added: DataFrame, mark: int | None = None) -> None:
        kept = self.live().where(~F.col("file").isin(list(touched))) if touched else self.live()
        self._commit(kept.unionByName(added, allowMissingColumns=True), self.schema(), self.mark() if mark is None else mark)

    def _names(self, rows: DataFrame) -> list[str]:
        """The live files that hold the given rows."""
        names = {r.n for r in rows.select(tail_of(F.col("_file")).alias("n")).distinct().collect()}
        return [r.file for r in self.live().select("file").collect() if tail(r.file) in names]

    def upsert(self, incoming: DataFrame, order: str, mark: int | None = None) -> int:
        """Put in the newest record of each key; a stored record is replaced as a whole.

        Touched files are those that hold an incoming key; keys that are new go to new files.
        Stored rows of the touched files and incoming rows are sorted by key in one shuffle, and the
        newest per key is taken in that order. Returns the number of keys that came in.
        """
        schema = self.schema()
        newest = store.latest_per_key(incoming.where(F.col(self.key).isNotNull()), self.key, order)
        touched = self._names(self.read(named=True).join(newest.select(self.key), self.key, "left_semi"))
        stored = self._files(touched, schema).withColumn("_new", F.lit(0))
        both = stored.unionByName(newest.select(*schema.names, F.lit(1).alias("_new"))).repartitionByRange(self.key)
        merged = store.latest_per_key(both, self.key, "_new").sortWithinPartitions(*self.partition_by, self.key)
        came = newest.agg(F.count(F.lit(1))).first()[0]
        if came or mark is not None:
            self._replace(touched, self._written(merged, schema), mark)
        return came

    def insert(self, rows: DataFrame) -> int:
        """Add rows; refused as a whole if a key is there already or comes twice.

        Only files whose key range meets that of the new rows are looked into.
        """
        bounds = rows.agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count(F.lit(1)).alias("n")).first()
        if not bounds.n:
            return 0
        near = self.live().where((F.col("low") <= bounds.high) & (F.col("high") >= bounds.low))
        twice = store.key_violations(rows, self.key)
        held = self.read(near).join(rows.select(self.key), self.key, "left_semi")
        if not twice.isEmpty() or not held.isEmpty():
            raise ValueError(f"{self.key} is there already")
        self._replace([], self._written(self._in_key_order(rows), self.schema()))
        return bounds.n

    def update(self, condition: Column, assignments: dict[str, Column], upsert: bool = False) -> int:
        """Conditional assignment to all matching rows; the number of rows that really changed."""
        if upsert:
            raise ValueError("an update of many rows inserts nothing; use update_one or upsert")
        rows = self.read(named=True)
        changes = store.update_where(rows, condition, assignments).where("changed")
        touched = self._names(changes)
        if not touched:
            return 0
        schema, seen = self.schema(), Observation()
        # Rows stay in their file's order, so the new files keep its key range without a shuffle.
        # Values that move a row to another partition are sorted out by the writer.
        changed = store.update_where(self._files(touched, schema), condition, assignments)
        counted = changed.observe(seen, F.count_if("changed").alias("n"))
        self._replace(touched, self._written(counted, schema))
        return seen.get["n"]

    def update_one(self, condition: Column, assignments: dict[str, Column], new_row: dict | None = None) -> int:
        """Change the first matching row by key; with ``new_row`` insert that if none matches.

        Returns 1 if a stored row changed, else 0 (an inserted row is not a changed one).
        """
        first = self.read(named=True).where(F.coalesce(condition, F.lit(False))).agg(F.min(self.key).alias("k")).first()
        if first.k is None:
            if new_row is not None:
                schema = self.schema()
                self.insert(self.spark.createDataFrame([tuple(new_row.get(n) for n in schema.names)], schema))
            return 0
        return self.update(F.col(self.key) == first.k, assignments)

    def delete(self, condition: Column) -> int:
        """Remove all matching rows; returns how many. Unknown conditions remove nothing."""
        hit = F.coalesce(condition, F.lit(False))
        touched = self._names(self.read(named=True).where(hit))
        if not touched:
            return 0
        schema = self.schema()
        held = self.live().where(F.col("file").isin(touched)).agg(F.sum("n_rows")).first()[0]
        left = self._written(store.delete_where(self._files(touched, schema), condition), schema)
        self._replace(touched, left)
        return held - (left.agg(F.sum("n_rows")).first()[0] or 0)

    def delete_one(self, condition: Column) -> int:
        first = self.read(named=True).where(F.coalesce(condition, F.lit(False))).agg(F.min(self.key).alias("k")).first()
        return 0 if first.k is None else self.delete(F.col(self.key) == first.k)

    def expire(self, day: str, before) -> int:
        """Remove whole days before the moment ``before``: ``day`` is a date partition column.

        Files of those days are dropped from the commit unread; their rows are known from it.
        """
        if day not in self.partition_by:
            raise ValueError(f"{day} is no partition column")
        old = F.try_element_at("parts", F.lit(day)).cast("date") < F.to_date(TM.moment(before))
        gone = self.live().where(F.coalesce(old, F.lit(False)))
        rows = gone.collect()
        if rows:
            self._replace([r.file for r in rows], self.spark.createDataFrame([], COMMIT))
        return sum(r.n_rows for r in rows)
