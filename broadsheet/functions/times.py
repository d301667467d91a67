"""Time windows and buckets. ``as_of`` stands for the wall clock, so results repeat."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

INTERVALS = ("hour", "day", "week")


def moment(value: datetime | str) -> Column:
    """A UTC moment as a zone-free timestamp literal; naive values are taken as UTC."""
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def since(column: Column, as_of: datetime | str, days: int) -> Column:
    """Trailing window from ``as_of - days`` up to ``as_of``; ``days`` of 0 or less means no bound."""
    if days <= 0:
        return F.lit(True)
    return column.between(moment(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"), moment(as_of))


def between(column: Column, start: datetime | str | None, end: datetime | str | None) -> Column:
    """Closed range with optional ends."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (column >= moment(start))
    if end is not None:
        condition = condition & (column <= moment(end))
    return condition


def bucket(column: Column, interval: str = "day") -> Column:
    """Bucket label of a timestamp: hour, day or ISO week; any other name means day."""
    if interval == "hour":
        return F.date_format(column, "yyyy-MM-dd-HH")
    if interval == "week":
        iso_year = F.lpad(F.date_part(F.lit("YEAROFWEEK"), column).cast("string"), 4, "0")
        return F.concat_ws("-", iso_year, F.lpad(F.weekofyear(column).cast("string"), 2, "0"))
    return F.date_format(column, "yyyy-MM-dd")


# The date layouts found on article pages.
PAGE_DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy.MM.dd HH:mm")


def parse_page_date(text: Column, as_of: datetime | str) -> Column:
    """First layout that fits wins; a date no layout fits becomes ``as_of``."""
    stripped = F.trim(text)
    tries = [F.try_to_timestamp(stripped, F.lit(f)).cast("timestamp_ntz") for f in PAGE_DATE_FORMATS]
    return F.coalesce(*tries, moment(as_of))


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a zone-free UTC timestamp; NULL when it does not parse.

    Text with an offset is converted to UTC whatever the session's zone; text without one is UTC.
    """
    local = F.try_to_timestamp(text).cast("timestamp_ntz")
    has_offset = text.rlike(r"T.*(Z|[+-]\d\d(:?\d\d)?)\s*$")
    return F.when(has_offset, F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)).otherwise(local)


def iso(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
