"""Stream topic names ``<prefix>.<category>.<stage>``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.schemas import CATEGORIES, STAGE_TABLES, TOPIC_PREFIX

# Subscription patterns.
RAW_PATTERN = r"news\..*\.raw"
SINK_PATTERN = r"^news\.[a-zA-Z0-9_-]+\.(processed|sentiment|summary)$"


def stage_pattern(stage: str, prefix: str = TOPIC_PREFIX) -> str:
    return rf"^{prefix}\..*\.{stage}$"


def topic_name(category: Column, stage: Column | str, prefix: str = TOPIC_PREFIX) -> Column:
    stage = F.lit(stage) if isinstance(stage, str) else stage
    return F.concat_ws(".", F.lit(prefix), category, stage)


def topic_part(topic: Column, index: int) -> Column:
    """Dot-separated part by zero-based index, ``unknown`` when there is none."""
    return F.coalesce(F.get(F.split(topic, r"\."), F.lit(index)), F.lit("unknown"))


def category_between(topic: Column, stage: str, prefix: str = TOPIC_PREFIX) -> Column:
    """What stands between prefix and stage suffix; NULL when the topic has another shape."""
    found = F.regexp_extract(topic, rf"^{prefix}\.(.*)\.{stage}$", 1)
    return F.when(found != "", found)


def topic_list(stage: str, categories: Iterable[str] | None = None, prefix: str = TOPIC_PREFIX) -> list[str]:
    """Explicit topics of one stage.

    ``None`` or anything that is not a list means every known category; unknown names in
    a list are dropped, so a list of unknown names yields no topic at all.
    """
    if not isinstance(categories, (list, tuple)):
        categories = CATEGORIES
    return [f"{prefix}.{c}.{stage}" for c in categories if c in CATEGORIES]


def replay_categories(
    argument: str | None = None,
    batch_category: str | None = None,
    stream_categories: list[str] | None = None,
) -> list[str]:
    """Which categories a replay reads: the argument, else the batch setting, else the
    stream's list, else all. An unknown argument stops the replay."""
    if argument:
        if argument not in CATEGORIES:
            raise ValueError(f"unknown category: {argument}")
        return [argument]
    if batch_category in CATEGORIES:
        return [batch_category]
    if isinstance(stream_categories, list):
        known = [c for c in stream_categories if c in CATEGORIES]
        if known:
            return known
    return list(CATEGORIES)


def target_table(topic: Column) -> Column:
    """Table a sink message belongs to; NULL when the topic is not a sink topic."""
    stage = F.regexp_extract(topic, SINK_PATTERN, 1)
    choice = F.lit(None).cast("string")
    for name, table in STAGE_TABLES.items():
        if name != "raw":
            choice = F.when(stage == name, F.lit(table)).otherwise(choice)
    return choice


def is_known_category(category: Column) -> Column:
    return category.isin(*CATEGORIES)


def display_name(category: Column) -> Column:
    """Display name from the fixed seven-entry dimension; NULL for other names."""
    return _lookup(category, CATEGORIES)


def category_code(category: Column) -> Column:
    """Display value with the fixed default for unknown names."""
    from broadsheet.schemas import DEFAULT_CATEGORY_CODE

    return F.coalesce(display_name(category), F.lit(DEFAULT_CATEGORY_CODE))


def _lookup(key: Column, mapping: dict[str, str]) -> Column:
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)
