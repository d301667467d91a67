"""Personal data, and terms that disclose it.

Base kinds are found by patterns. Then the corpus says which other terms reveal a protected
value: for a value e and a term t near it, the pointwise mutual information of the two is

    log2(p(e|t) N / n(e)),  p(e|t) = (n(e,t) + n(e) / N) / (n(t) + 1),

with document counts over the whole corpus: n(e) documents mention e, n(t) contain t, n(e,t)
have t within ``NEAR`` characters of e. Left is the uncertainty about the value once the term is
known, -log2 p(e|t) bits, whatever the size of the corpus: at 0 the term names the value as surely as
the value itself. The one document added to n(t), with e as likely as anywhere, holds back what few
documents say; values and terms of any number of documents take part. A term that leaves
``DISCLOSES`` bits or less of some value is a span of the kind term wherever it stands, near the
value or in other texts, except inside base spans: up to ``REMOVES`` bits it is removed, above
it is generalised to [WORD].

JVM functions only. Contexts are cut around each value, so their number grows with the number
of values, never with pairs of documents. Null and empty texts have no spans; rows with a null id or
a repeated id are marked by their own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import spans, tables

LOCAL = "[A-Za-z0-9._%+-]"
#: Possessive runs that start at a run's first character (or where the last match ended) find
#: the same matches as greedy ones and need one step per character.
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
WORD = r"\p{L}{3,}+"
NEAR = 64
#: Bits of uncertainty about a value that a term may leave and still counts as disclosing it.
DISCLOSES = 2.0
REMOVES = 0.5


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Check sum of a string of digits, from the right every second one doubled."""
    figures = F.transform(F.split(F.reverse(value), "(?<=.)(?=.)"), lambda c: c.cast("int"))
    weighed = F.transform(
        figures,
        lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)),
    )
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10 == 0


def between(column: Column, low: int, high: int) -> Column:
    return (column >= low) & (column <= high)


def base_kinds(text: Column) -> dict[str, Column]:
    """Per kind the matches that hold; a cheap test of the text comes before each search."""
    parts = lambda x: F.split(x["value"], r"\.")
    small = lambda p: (F.char_length(F.ltrim(p, F.lit("0"))) <= 3) & (
        F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255
    )
    return {
        "email": spans.where(text.contains("@"), spans.matches(text, EMAIL)),
        "ip": F.filter(
            spans.where(text.rlike(r"[0-9]\.[0-9]"), spans.matches(text, IP)),
            lambda x: F.forall(parts(x), small),
        ),
        "card": F.filter(
            spans.where(text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), spans.matches(text, CARD)),
            lambda x: between(F.char_length(digits(x["value"])), 13, 19) & luhn(digits(x["value"])),
        ),
        "phone": F.filter(
            spans.where(text.rlike(r"\+[0-9]"), spans.matches(text, PHONE)),
            lambda x: between(F.char_length(digits(x["value"])), 9, 15),
        ),
    }


def based(docs: DataFrame) -> DataFrame:
    """doc_id and found: base spans with the characters on either side."""
    text = F.col("text")

    def placed(rank: int, kind: str, found: Column) -> Column:
        return F.transform(
            found,
            lambda x: F.struct(
                F.lit(rank).alias("rank"),
                x["start"].alias("start"),
                x["end"].alias("end"),
                F.lit(kind).alias("kind"),
                F.when(F.lit(kind) == "email", F.lower(x["value"]))
                .when(F.lit(kind) == "ip", x["value"])
                .otherwise(digits(x["value"]))
                .alias("value"),
                F.substring(
                    text, F.greatest(x["start"] - NEAR, F.lit(0)) + 1, F.least(x["start"], F.lit(NEAR))
                ).alias("left"),
                F.substring(text, x["end"] + 1, F.lit(NEAR)).alias("right"),
            ),
        )

    kinds = enumerate(base_kinds(text).items())
    parts = [placed(rank, kind, found) for rank, (kind, found) in kinds]
    return docs.select("doc_id", "hash", F.array_sort(F.concat(*parts)).alias("found"))


def named(x: str) -> Column:
    return F.concat_ws(":", f"{x}.kind", f"{x}.value").alias("value")


def nearby(found: DataFrame) -> DataFrame:
    """(doc_id, hash, value, term): whole words near each value."""
    one = found.select("doc_id", "hash", F.explode("found").alias("x")).select(
        "doc_id", "hash", named("x"), "x.left", "x.right"
    )

    def words_of(side: str) -> DataFrame:
        cut = F.char_length(side) >= NEAR
        edge = (lambda x: x["start"] == 0) if side == "left" else (lambda x: x["end"] == NEAR)
        whole = F.filter(spans.matches(F.col(side), WORD), lambda x: ~(cut & edge(x)))
        return one.select("doc_id", "hash", "value", F.explode(whole).alias("w"))

    sides = words_of("left").union(words_of("right"))
    return sides.select("doc_id", "hash", "value", F.lower("w.value").alias("term")).distinct()


def words_of_text() -> Column:
    return F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))


def disclosing(rows: DataFrame, found: DataFrame, near: DataFrame) -> DataFrame:
    """(term, bits left) of the terms that disclose some value, from counts over all rows."""
    total = rows.count()
    pairs = near.groupBy("value", "term").agg(F.count("*").alias("n_both"))
    values = (
        found.select("doc_id", "hash", F.explode("found").alias("x"))
        .select("doc_id", "hash", named("x"))
        .distinct()
        .groupBy("value")
        .agg(F.count("*").alias("n_value"))
        .filter(F.col("n_value") < total)
    )
    terms = (
        rows.select(F.explode(F.array_distinct(F.transform(words_of_text(), F.lower))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n_term"))
    )
    odds = F.lit(total) / F.col("n_value")
    given = (F.col("n_both") + 1 / odds) / (F.col("n_term") + 1)
    return (
        pairs.join(values, "value")
        .join(terms, "term")
        .select("term", (-F.log2(given)).alias("left"))
        .filter(F.col("left") <= DISCLOSES)
        .groupBy("term")
        .agg(F.min("left").alias("left"))
    )


def occurrences(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, hash, term, start, end): places of the terms in all texts.

    The distinct words of every text meet the terms in a join, whose strategy is Catalyst's choice
    by the size of the terms; then only texts that hold a term are searched, each for its own.
    """
    words = rows.select("doc_id", "hash", F.explode(words_of_text()).alias("form"))
    mine = (
        words.withColumn("term", F.lower("form"))
        .join(terms.select("term"), "term", "left_semi")
        .groupBy(F.col("doc_id").alias("at"), F.col("hash").alias("at_hash"))
        .agg(F.collect_set("form").alias("forms"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("at")) & (F.col("hash") == F.col("at_hash"))
    # Forms are letters only, and WORD takes whole runs of letters.
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join("forms", "|"), F.lit(r")(?!\p{L})"))
    # One plan at every size: texts meet their terms in a shuffle.
    return (
        rows.join(tables.written(mine, "forms").hint("shuffle_hash"), same)
        .select("doc_id", "hash", F.explode(spans.matches(F.col("text"), pattern)).alias("w"))
        .select("doc_id", "hash", F.lower("w.value").alias("term"), "w.start", "w.end")
    )


def found_spans(docs: DataFrame) -> DataFrame:
    """doc_id, found and terms: arrays of struct<rank, start, end, kind>, with the term's fate."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    found = tables.written(based(rows), "base")
    near = tables.written(nearby(found), "near")
    terms = tables.written(disclosing(rows, found, near), "terms")
    marked = (
        occurrences(rows, terms)
        .join(terms, "term")
        .groupBy(F.col("doc_id").alias("at"), F.col("hash").alias("at_hash"))
        .agg(
            F.array_sort(
                F.collect_set(
                    F.struct(
                        F.lit(len(KINDS) - 1).alias("rank"),
                        "start",
                        "end",
                        F.lit(KINDS[-1]).alias("kind"),
                        (F.col("left") <= REMOVES).alias("removed"),
                    )
                )
            ).alias("terms")
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("at")) & (F.col("hash") == F.col("at_hash"))
    outside = F.filter(
        "terms", lambda t: ~F.exists("found", lambda x: (x["start"] < t["end"]) & (t["start"] < x["end"]))
    )
    return found.join(marked, same, "left").select("doc_id", "found", outside.alias("terms"))


def reported(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base kinds, and all spans as one string."""
    found = found_spans(docs)
    counts = [spans.counted("found", k) for k in KINDS[:4]]
    base = spans.listed(F.col("found"))
    more = spans.listed(F.col("terms"))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(more, F.lit(""))).alias("spans"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """doc_id and text with values generalised to their kind, terms generalised or removed.

    Ids are unique and not null here; texts meet their spans by id.
    """
    found = found_spans(docs)
    masked = F.concat(
        F.transform(
            "found",
            lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("mask")),
        ),
        F.transform(
            F.coalesce("terms", F.array().cast("array<struct<rank:int,start:int,end:int,kind:string,removed:boolean>>")),
            lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.when(x["removed"], F.lit("")).otherwise(F.lit("[WORD]")).alias("mask")),
        ),
    )
    named = found.select(F.col("doc_id").alias("at"), F.array_sort(masked).alias("masks"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.join(named, F.col("doc_id") == F.col("at")).select(
        "doc_id", spans.replaced(F.col("text"), F.col("masks"), lambda x: x["mask"]).alias("text")
    )
