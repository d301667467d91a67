"""Registered queries and the SQL each one is checked against."""

from broadsheet.plans import analytics, changes, checks, reading, sinks, streams, texts  # noqa: F401
from broadsheet.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
