"""Reading inputs, cutting lineage through the shared folder, and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.session import file_system, fresh_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder; lost executors lose nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is planned and run here drops its shuffle files when it ends; otherwise they stay until
    the driver happens to collect its garbage. Only for frames that are run once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    given = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, given)


def stored(df: DataFrame, name: str, by: str | None = None) -> tuple[DataFrame, str]:
    """As ``written``, with a folder for each value of ``by``, and the path. Its shuffles go at once."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with shuffles_dropped(spark):
        writer = df.write.partitionBy(by) if by else df.write
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Drop a table that nothing reads any more."""
    files, at = file_system(spark, path)
    files.delete(at, True)


def components(edges: DataFrame, start: DataFrame) -> DataFrame:
    """Smallest reachable label of each node.

    ``edges`` has (a, b), ``start`` (id, comp) with every node once. Each round takes the
    smallest label among the neighbours and then that label's own label, so chains shorten
    geometrically; rounds go on until nothing changes.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges"
    )
    labels = start.select("id", "comp")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("id"))
            .groupBy("a")
            .agg(F.min("comp").alias("seen"))
        )
        hooked = labels.join(near, F.col("id") == F.col("a"), "left").select(
            "id", F.col("comp").alias("old"), F.least("comp", "seen").alias("comp")
        )
        jump = hooked.select(F.col("id").alias("at"), F.col("comp").alias("then"))
        moved = written(
            hooked.join(jump, F.col("comp") == F.col("at"), "left").select(
                "id", "old", F.least("comp", "then").alias("comp")
            ),
            "labels",
        )
        labels = moved.select("id", "comp")
        if moved.filter(F.col("old") != F.col("comp")).isEmpty():
            return labels
