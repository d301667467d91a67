"""A written index of title words and keywords, so that a search reads postings and no texts.

Three Parquet tables:
  postings  (bucket, field, term, url): which articles hold a term, in folders by bucket and in
            order of term, so a very common term is spread over as many files as it needs
  terms     (term): every word that occurs in a title
  cards     the columns that a result shows or is filtered by, one row per article

A query term has no white space, so a title contains it just where one of its words does:
the words are looked up in ``terms``, their postings by bucket. Keyword terms are equal to the posting's.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import predicates as PR
from broadsheet.functions import sentiment as S
from broadsheet.functions import times as TM
from broadsheet.operators import search

BUCKETS = 64
TITLE, KEYWORD = "title", "keyword"
CARD = ("url", "title", "press", "category", "published_at", "sentiment_analysis")


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def entries(articles: DataFrame) -> DataFrame:
    """field, term, url: each article's different title words and keywords."""
    words = F.array_distinct(F.split(F.lower("title"), r"\s+"))
    fields = F.array(
        F.struct(F.lit(TITLE).alias("field"), F.coalesce(words, F.array().cast("array<string>")).alias("terms")),
        F.struct(
            F.lit(KEYWORD).alias("field"),
            F.coalesce(F.array_distinct("keywords"), F.array().cast("array<string>")).alias("terms"),
        ),
    )
    listed = articles.select("url", F.explode(fields).alias("f")).select("url", "f.field", F.explode("f.terms").alias("term"))
    return listed.where("term IS NOT NULL AND term <> ''").select("field", "term", "url")


def build(articles: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write the index of articles (one row per url). The texts' keywords are read once here."""
    found = entries(articles).withColumn("bucket", bucket_of(F.col("term"), buckets))
    dealt = found.repartitionByRange("bucket", "field", "term", "url").sortWithinPartitions("bucket", "field", "term", "url")
    dealt.write.mode("overwrite").partitionBy("bucket", "field").parquet(f"{path}/postings")
    spark = articles.sparkSession
    titles = postings(spark, path).where(F.col("field") == TITLE)
    titles.groupBy("term").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/terms")
    cards = articles.select(*CARD).repartitionByRange("published_at", "url")
    cards.sortWithinPartitions("published_at", "url").write.mode("overwrite").parquet(f"{path}/cards")


def postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("term string, url string, bucket int, field string").parquet(f"{path}/postings")


def buckets_of(spark: SparkSession, path: str, terms: Iterable[str], buckets: int) -> list[int]:
    """Bucket numbers of some terms, by the same function that placed them."""
    asked = spark.createDataFrame([(t,) for t in terms], "term string")
    return sorted({r.b for r in asked.select(bucket_of(F.col("term"), buckets).alias("b")).collect()})


def urls_of(spark: SparkSession, path: str, field: str, terms: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Urls of the articles that hold one of the terms: only the terms' buckets are read."""
    chosen = F.col("bucket").isin(buckets_of(spark, path, terms, buckets))
    return postings(spark, path).where(chosen & (F.col("field") == field) & F.col("term").isin(terms)).select("url")


def title_urls(spark: SparkSession, path: str, terms: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Urls of the articles whose title contains one of the terms.

    The matching words come from the list of terms; their buckets prune the postings at run time.
    """
    known = spark.read.schema("term string").parquet(f"{path}/terms")
    matching = known.where(PR.any_of(F.col("term").contains(t) for t in terms))
    words = matching.select(F.col("term").alias("t"), bucket_of(F.col("term"), buckets).alias("b"))
    titles = postings(spark, path).where(F.col("field") == TITLE)
    same = (F.col("bucket") == F.col("b")) & (F.col("term") == F.col("t"))
    return titles.join(words, same, "left_semi").select("url")


def matches(spark: SparkSession, path: str, request: search.SearchRequest, buckets: int = BUCKETS) -> DataFrame:
    """Cards of all articles that a search request names; the same rows as a search of the texts."""
    clauses = []
    if request.categories:
        clauses.append(F.col("category").isin(list(request.categories)))
    if request.sentiments:
        clauses.append(S.label_of().isin(list(request.sentiments)))
    if request.start_date or request.end_date:
        clauses.append(TM.between(F.col("published_at"), request.start_date, request.end_date))
    if request.press:
        clauses.append(F.col("press").isin(list(request.press)))
    cards = spark.read.parquet(f"{path}/cards").where(PR.all_of(clauses))
    if request.query.strip():
        terms = request.query.lower().split()
        by_keyword = urls_of(spark, path, KEYWORD, terms, buckets)
        if request.literal:
            by_title = title_urls(spark, path, terms, buckets)
        else:
            by_title = cards.where(PR.title_matches(F.col("title"), request.query, literal=False)).select("url")
        cards = cards.join(by_keyword.unionByName(by_title), "url", "left_semi")
    wanted = [urls_of(spark, path, KEYWORD, [k.lower()], buckets) for k in request.include_keywords]
    cards = reduce(lambda rows, urls: rows.join(urls, "url", "left_semi"), wanted, cards)
    if request.exclude_keywords:
        unwanted = [k.lower() for k in request.exclude_keywords]
        cards = cards.join(urls_of(spark, path, KEYWORD, unwanted, buckets), "url", "left_anti")
    return cards


def find(spark: SparkSession, path: str, request: search.SearchRequest, buckets: int = BUCKETS) -> DataFrame:
    """One page of a search, newest first, with the number of all matches."""
    return search.page_with_total(matches(spark, path, request, buckets), F.lit(True), request.page, request.size)
