"""Trending keywords, scores, keyword sentiment and the co-occurrence network."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.operators.trends import recent


def trending(df: DataFrame, as_of, category: str | None = None, days: int = 7, limit: int = 20) -> DataFrame:
    """Most frequent keywords in the window. Counts combine map-side; the limit is a top-k."""
    return (
        recent(df, as_of, days, category, at="processed_at")
        .select(F.explode("keywords").alias("keyword"))
        .where(F.col("keyword") != "")
        .groupBy("keyword")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("keyword"))
        .limit(limit)
    )


def keyword_scores(df: DataFrame, as_of, days: int = 7, limit: int = 20) -> DataFrame:
    """Count, document count and ``count * ln((N + 1) / (df + 1))``, best scores first.

    Each row is one url, so the first occurrence of a keyword in a row marks its document
    and no distinct shuffle is needed. One more entry per article counts N in the same
    grouping. N is read from the grouped rows with all of their columns, so Spark reuses
    the shuffle and the texts are read once.
    """
    window = recent(df, as_of, days, at="processed_at").where(F.size("keywords") > 0)
    words = F.transform(
        "keywords",
        lambda k, i: F.struct(
            F.lit(False).alias("article"),
            k.alias("keyword"),
            (F.array_position("keywords", k) == i + 1).alias("first"),
        ),
    )
    article = F.struct(
        F.lit(True).alias("article"), F.lit(None).cast("string").alias("keyword"), F.lit(False).alias("first")
    )
    grouped = (
        window.select(F.explode(F.concat(F.array(article), words)).alias("k"))
        .groupBy("k.article", "k.keyword")
        .agg(
            # An aggregate, so that the filter below stays above the shared shuffle.
            F.max("k.article").alias("whole"),
            F.count(F.lit(1)).alias("count"),
            F.count_if("k.first").alias("doc_count"),
        )
        .drop("article")
    )
    total = grouped.agg(F.max(F.struct("whole", "count", "doc_count", "keyword"))["count"]).scalar()
    counted = grouped.where(~F.col("whole")).drop("whole")
    score = F.round(F.col("count") * F.log((total + 1) / (F.col("doc_count") + 1)), 6)
    return (
        counted.withColumns({"score": score, "total_articles": total})
        .orderBy(F.desc("score"), F.asc("keyword"))
        .limit(limit)
    )


def keyword_sentiment(df: DataFrame, as_of, days: int = 7, limit: int = 20) -> DataFrame:
    """Trending keywords with label counts; keywords and label sit in the same row."""
    return (
        recent(df, as_of, days, at="processed_at")
        .select(F.explode("keywords").alias("keyword"), S.label_of().alias("label"))
        .groupBy("keyword")
        .agg(F.count(F.lit(1)).alias("count"), *S.label_counts(F.col("label")))
        .orderBy(F.desc("count"), F.asc("keyword"))
        .limit(limit)
    )


def related(docs: DataFrame, sources: DataFrame, per_node: int) -> DataFrame:
    """Top keywords seen together with each source keyword: ``source, target, weight``.

    ``sources`` holds at most ``per_node ** level`` keywords, a bound fixed by the
    parameters. Only pairs with a source keyword are built.
    Counts combine map-side before the shuffle and the rank filter is a group limit.
    """
    pairs = (
        docs.select("keywords", F.explode(F.array_distinct("keywords")).alias("source"))
        .join(sources, "source")
        .select("source", F.explode("keywords").alias("target"))
        .where("source <> target")
    )
    counted = pairs.groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))
    window = Window.partitionBy("source").orderBy(F.desc("weight"), F.asc("target"))
    return (
        counted.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= per_node).drop("rank")
    )


def network_edges(
    df: DataFrame, keyword: str, as_of, depth: int = 1, days: int = 7, per_node: int = 10
) -> DataFrame:
    """Edges around a keyword up to ``depth`` (1 to 3): each edge with its least depth.

    A keyword is expanded once, at the level it is first reached.
    """
    if not 1 <= depth <= 3:
        raise ValueError("depth lies between 1 and 3")
    center = keyword.lower()
    docs = recent(df, as_of, days, at="processed_at").select("keywords")
    spark = df.sparkSession
    frontier = spark.createDataFrame([(center,)], "source string")
    reached = frontier
    edges = None
    for level in range(1, depth + 1):
        base = docs.where(F.array_contains("keywords", center)) if level == 1 else docs
        found = related(base, frontier, per_node).withColumn("depth", F.lit(level))
        edges = found if edges is None else edges.unionByName(found)
        if level < depth:
            frontier = (
                found.select(F.col("target").alias("source")).distinct().join(reached, "source", "left_anti")
            )
            reached = reached.union(frontier)
    return edges


def network_nodes(df: DataFrame, edges: DataFrame, keyword: str, as_of, days: int = 7) -> DataFrame:
    """Center (group 1, size 20) and related keywords (group depth + 1, size 10 + weight).

    The center appears as soon as one article in the window carries it; without such an
    article there is no node at all.
    """
    center = keyword.lower()
    carrying = recent(df, as_of, days, at="processed_at").where(F.array_contains("keywords", center))
    middle = carrying.select(
        F.lit(center).alias("id"), F.lit(1).alias("group"), F.lit(20).cast("bigint").alias("size")
    ).limit(1)
    best = F.min(F.struct("depth", (-F.col("weight")).alias("neg_weight"))).alias("best")
    others = (
        edges.where(F.col("target") != center)
        .groupBy("target")
        .agg(best)
        .select(
            F.col("target").alias("id"),
            (F.col("best.depth") + 1).alias("group"),
            (F.lit(10) - F.col("best.neg_weight")).alias("size"),
        )
    )
    return middle.unionByName(others)
