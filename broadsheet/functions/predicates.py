"""Search predicates over scalars and keyword arrays, with the store's null rules."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(conditions: Iterable[Column]) -> Column:
    """Conjunction; no condition means every row."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    """Disjunction; no condition means no row."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def strings(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def has_any(array: Column, values: Iterable[str]) -> Column:
    return F.arrays_overlap(array, strings(values))


def has_all(array: Column, values: Iterable[str]) -> Column:
    wanted = [v.lower() for v in values]
    return all_of(F.array_contains(array, v) for v in wanted)


def has_none(array: Column, values: Iterable[str]) -> Column:
    """True also for rows whose array is missing or empty."""
    wanted = [v.lower() for v in values]
    return ~F.coalesce(F.arrays_overlap(array, strings(wanted)), F.lit(False))


def title_matches(title: Column, query: str, literal: bool = True) -> Column:
    """Case-insensitive match of any white-space separated term.

    By default a term is plain text; ``literal=False`` reads each term as a regular
    expression, and a malformed one raises.
    """
    terms = query.lower().split()
    if literal:
        lowered = F.lower(title)
        return any_of(lowered.contains(t) for t in terms)
    return any_of(title.rlike(f"(?i){t}") for t in terms)


def text_matches(title: Column, keywords: Column, query: str, literal: bool = True) -> Column:
    """A title term matches, or a keyword equals a term."""
    terms = query.lower().split()
    in_title = F.coalesce(title_matches(title, query, literal), F.lit(False))
    return in_title | F.coalesce(has_any(keywords, terms), F.lit(False))
