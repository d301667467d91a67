"""Spans of pattern matches as array columns, with JVM functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import let


NONE = "array<struct<start:int,end:int,value:string>>"


def running(sizes: Column, start: Column) -> Column:
    """For each number what came before it, from ``start`` on; quadratic, for short arrays only."""
    state = F.struct(start.alias("at"), F.array().cast("array<int>").alias("before"))
    return F.aggregate(
        sizes,
        state,
        lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["before"], F.array(s["at"])).alias("before")),
        lambda s: s["before"],
    )


def in_parts(values: Column, total, prefix) -> Column:
    """``prefix`` (what came before each value) over an array cut into about as many parts as each
    then has values: first over the parts' totals, then within each part from its own start.

    A million values take seconds, where one run over all of them takes hours.
    """

    def cut(all_: Column) -> Column:
        part = F.greatest(F.ceil(F.sqrt(F.size(all_))).cast("int"), F.lit(1))
        last = F.greatest(F.ceil(F.size(all_) / part).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_, i * part + 1, part))

    def joined(parts: Column) -> Column:
        return F.flatten(F.zip_with(parts, prefix(F.transform(parts, total), F.lit(0)), prefix))

    return let(values, lambda v: let(cut(v), joined))


def running_sums(sizes: Column) -> Column:
    """For each number the sum of those before it."""
    return in_parts(sizes, lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x), running)


def matches(text: Column, pattern: str | Column) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points.

    Splitting at the matches gives the gaps between them; lengths of gaps and matches add up to
    the places. What a lambda reads is bound by ``let``, or it would be computed for each element.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))  # lit leaves a Column as it is
    gaps = F.split(text, pattern, -1)

    def placed(values: Column) -> Column:
        steps = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(values)),
            values,
            lambda gap, value: F.char_length(gap) + F.char_length(value),
        )
        return let(
            steps,
            lambda s: F.zip_with(
                values,
                F.zip_with(running_sums(s), s, lambda before, step: before + step),
                lambda value, end: F.struct(
                    (end - F.char_length(value)).alias("start"), end.alias("end"), value.alias("value")
                ),
            ),
        )

    return let(found, lambda v: F.when(F.size(v) > 0, placed(v)).otherwise(F.array().cast(NONE)))


def where(condition: Column, found: Column) -> Column:
    """The matches where a cheap condition on the text holds, else none."""
    return F.when(condition, found).otherwise(F.array().cast(NONE))


def listed(found: Column) -> Column:
    """``kind:start:end`` of each struct, joined by commas."""
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


#: Code points of a block of text, within which places are counted from its start.
BLOCK = 1024


def stretch(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text cut into blocks, reading only the blocks it touches."""
    first = F.floor(start / BLOCK).cast("int")
    near = F.array_join(F.slice(blocks, first + 1, F.floor((end - 1) / BLOCK).cast("int") - first + 1), "")
    return F.when(end > start, F.substring(near, start - first * BLOCK + 1, end - start)).otherwise("")


def furthest(ends: Column, start: Column) -> Column:
    """For each number the greatest before it, from ``start`` on; quadratic, for short arrays only."""
    state = F.struct(start.alias("at"), F.array().cast("array<int>").alias("before"))
    return F.aggregate(
        ends,
        state,
        lambda s, x: F.struct(F.greatest(s["at"], x).alias("at"), F.concat(s["before"], F.array(s["at"])).alias("before")),
        lambda s: s["before"],
    )


def replaced(text: Column, found: Column, mask) -> Column:
    """The text with each span replaced by ``mask(span)``; ``found`` ordered by start.

    Spans that begin inside an earlier one extend what is taken out without a mask of their own.
    The text is read in blocks, so a span costs as much at the end of a long text as at its start.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def masked(spans_: Column) -> Column:
        ends = F.transform(spans_, lambda x: x["end"])
        reached = in_parts(ends, F.array_max, furthest)

        def put(b: Column) -> Column:
            pieces = F.zip_with(
                spans_,
                reached,
                lambda x, at: F.when(x["start"] >= at, F.concat(stretch(b, at, x["start"]), mask(x))).otherwise(""),
            )
            return F.concat(F.array_join(pieces, ""), stretch(b, F.array_max(ends), F.char_length(text)))

        return let(blocks, put)

    return let(found, lambda f: F.when(F.size(f) > 0, masked(f)).otherwise(text))


def counted(found: str, kind: str) -> Column:
    """How many structs of an array column are of one kind, as n_<kind>."""
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
