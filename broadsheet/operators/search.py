"""Article listing and search."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import predicates as PR
from broadsheet.functions import sentiment as S
from broadsheet.functions import times as TM
from broadsheet.operators import store

NEWEST_FIRST = (("published_at", -1),)


@dataclass
class SearchRequest:
    """Optional clauses, joined by AND; page from 1, size 1 to 100."""

    query: str = ""
    categories: Sequence[str] = ()
    sentiments: Sequence[str] = ()
    press: Sequence[str] = ()
    start_date: datetime | str | None = None
    end_date: datetime | str | None = None
    include_keywords: Sequence[str] = ()
    exclude_keywords: Sequence[str] = ()
    page: int = 1
    size: int = 20
    literal: bool = field(default=True)

    def __post_init__(self):
        if self.page < 1 or not 1 <= self.size <= 100:
            raise ValueError("page starts at 1 and size lies between 1 and 100")


def condition_of(request: SearchRequest) -> Column:
    clauses = []
    if request.query.strip():
        clauses.append(PR.text_matches(F.col("title"), F.col("keywords"), request.query, request.literal))
    if request.categories:
        clauses.append(F.col("category").isin(list(request.categories)))
    if request.sentiments:
        clauses.append(S.label_of().isin(list(request.sentiments)))
    if request.start_date or request.end_date:
        clauses.append(TM.between(F.col("published_at"), request.start_date, request.end_date))
    if request.press:
        clauses.append(F.col("press").isin(list(request.press)))
    if request.include_keywords:
        clauses.append(PR.has_all(F.col("keywords"), request.include_keywords))
    if request.exclude_keywords:
        clauses.append(PR.has_none(F.col("keywords"), request.exclude_keywords))
    return PR.all_of(clauses)


def page_with_total(df: DataFrame, condition: Column, page: int, size: int) -> DataFrame:
    """One page, newest first, plus the number of all matches in ``total``.

    The total is a scalar subquery over the same filter: one number, not a join.
    """
    matches = df.where(condition)
    total = matches.agg(F.count(F.lit(1))).scalar()
    rows = store.find_many(matches, sort=NEWEST_FIRST, skip=(page - 1) * size, limit=size)
    return rows.withColumn("total", total)


def search(df: DataFrame, request: SearchRequest) -> DataFrame:
    return page_with_total(df, condition_of(request), request.page, request.size)


def list_articles(
    df: DataFrame,
    category: str | None = None,
    sentiment: str | None = None,
    start_date: datetime | str | None = None,
    end_date: datetime | str | None = None,
    days: int | None = None,
    as_of: datetime | str | None = None,
    page: int = 1,
    size: int = 20,
) -> DataFrame:
    """Filtered listing, newest first, by explicit dates or by a trailing window."""
    clauses = []
    if category:
        clauses.append(F.col("category") == category)
    if sentiment:
        clauses.append(S.label_of() == sentiment)
    clauses.append(TM.between(F.col("published_at"), start_date, end_date))
    if days is not None:
        clauses.append(TM.since(F.col("published_at"), as_of, days))
    return page_with_total(df, PR.all_of(clauses), page, size)


def by_url(df: DataFrame, url: str) -> DataFrame:
    return store.find_one(df, F.col("url") == url)


def by_category(df: DataFrame, category: str, limit: int = 10, skip: int = 0) -> DataFrame:
    return store.find_many(df, F.col("category") == category, sort=NEWEST_FIRST, skip=skip, limit=limit)


def by_sentiment(df: DataFrame, sentiment: str, limit: int = 10, skip: int = 0) -> DataFrame:
    return store.find_many(df, S.label_of() == sentiment, sort=NEWEST_FIRST, skip=skip, limit=limit)


def by_date_range(df: DataFrame, start, end, limit: int = 0, skip: int = 0) -> DataFrame:
    return store.find_many(
        df, TM.between(F.col("published_at"), start, end), sort=NEWEST_FIRST, skip=skip, limit=limit
    )


def latest_summaries(df: DataFrame, category: str | None = None, limit: int = 10) -> DataFrame:
    condition = F.col("category") == category if category else None
    return store.find_many(df, condition, sort=NEWEST_FIRST, limit=limit)
