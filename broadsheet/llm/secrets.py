"""Secret scans through a trigram inverted index.

From each rule's pattern a Boolean trigram query is derived: alternatives (OR) of the trigrams
that every match of that alternative must contain (AND). The index posts a document under each
of these trigrams that its lower-cased text contains; intersecting postings gives the
candidates of a rule, and only candidates are searched with its pattern. A rule without a
mandatory trigram (runs of hex digits) searches all texts.

JVM functions only. Null and empty texts have no secrets. Rows with a null id are not in the
index and are searched with every rule. An id that several rows carry makes each of them a
candidate; each is verified on its own text.
"""

from __future__ import annotations

import re
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import spans

VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?(" + VALUE + "+)"
)
#: kind: pattern, in the order of reports. The first three are the base rules.
RULES = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{16,}+",
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack": r"xox[abpr]-[A-Za-z0-9-]{10,}",
    "google": r"AIza[0-9A-Za-z_-]{35}",
    "webtoken": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "private": r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----",
}
SHORTEST_VALUE = 12


def alternatives(pattern: str) -> list[frozenset[str]]:
    """The trigram query of a pattern: a match contains all trigrams of one alternative.

    An empty alternative means that a match need not contain any trigram.
    """

    def of(items) -> list[frozenset[str]]:
        found, run = [frozenset()], ""

        def add(options: list[frozenset[str]]) -> None:
            nonlocal found
            found = [a | b for a in found for b in options]

        def close() -> None:
            nonlocal run
            add([frozenset(run[i : i + 3] for i in range(len(run) - 2))])
            run = ""

        for op, value in items:
            if op is sre.LITERAL:
                run += chr(value).lower()
                continue
            close()
            if op is sre.SUBPATTERN:
                add(of(value[3]))
            elif op is sre.BRANCH:
                add([x for option in value[1] for x in of(option)])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and value[0] > 0:
                add(of(value[2]))
        close()
        return found

    return of(_parser.parse(pattern))


def indexed(rules: dict[str, str]) -> dict[str, list[frozenset[str]]]:
    """Rules whose every alternative has a trigram."""
    found = {kind: alternatives(pattern) for kind, pattern in rules.items()}
    return {kind: options for kind, options in found.items() if all(options)}


def candidates(docs: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(at, rules): ids of documents and the rules whose trigram query they satisfy."""
    queries = indexed(rules)
    wanted = sorted({g for options in queries.values() for option in options for g in option})
    lowered = F.lower("text")
    present = F.filter(
        F.array(*[F.when(F.contains(lowered, F.lit(g)), F.lit(g)) for g in wanted]),
        lambda g: g.isNotNull(),
    )
    postings = docs.filter("doc_id IS NOT NULL").select("doc_id", F.explode(present).alias("gram"))
    clauses = [
        (kind, number, len(option), gram)
        for kind, options in queries.items()
        for number, option in enumerate(options)
        for gram in sorted(option)
    ]
    # A fixed table of the rules' own trigrams; its size does not depend on the data.
    table = docs.sparkSession.createDataFrame(clauses, "rule string, clause int, need int, gram string")
    met = (
        postings.join(F.broadcast(table), "gram")
        .groupBy("doc_id", "rule", "clause")
        .agg(F.count_distinct("gram").alias("have"), F.first("need").alias("need"))
        .filter("have = need")
    )
    return met.groupBy(F.col("doc_id").alias("at")).agg(F.collect_set("rule").alias("rules"))


def rule_spans(text: Column, kind: str, pattern: str, asked: Column) -> Column:
    """Matches of one rule with its name and rank in the report."""
    found = spans.where(asked & text.rlike(pattern), spans.matches(text, pattern))
    if kind == "assign":
        found = F.filter(
            found,
            lambda x: F.char_length(F.regexp_extract(x["value"], pattern, 2)) >= SHORTEST_VALUE,
        )
    rank = list(RULES).index(kind)
    return F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def scanned(docs: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) with ``found_secrets``: an array of
    struct<start, rank, end, kind> by start, then rule. A null text stays null and has none.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    known = indexed(rules)
    asked = docs.join(
        candidates(rows, rules).withColumnsRenamed({"at": "secret_at", "rules": "secret_rules"}).hint("shuffle_hash"),
        F.col("doc_id") == F.col("secret_at"),
        "left",
    )

    def wanted(kind: str) -> Column:
        if kind not in known:
            return F.lit(True)
        met = F.array_contains("secret_rules", kind)
        return F.col("doc_id").isNull() | F.coalesce(met, F.lit(False))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = [rule_spans(text, k, p, wanted(k)) for k, p in rules.items()]
    return asked.select(*docs.columns, F.array_sort(F.concat(*parts)).alias("found_secrets"))


def reported(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base rules, and all spans as one string."""
    kinds = ["assign", "access", "hex"]
    found = scanned(docs.select("doc_id", "text")).select("doc_id", F.col("found_secrets").alias("found"))
    base = F.filter("found", lambda x: x["rank"] < len(kinds))
    counts = [spans.counted("found", k) for k in kinds]
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *counts,
        F.sha2(spans.listed(base), 256).alias("base_sha256"),
        spans.listed(F.col("found")).alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with every secret replaced by its rule's name.

    Where ``docs`` has n_chars, it follows the text of rows that changed.
    """
    found = scanned(docs)
    changed = F.size("found_secrets") > 0
    masked = spans.replaced(
        F.col("text"), F.col("found_secrets"), lambda x: F.concat(F.lit("["), x["kind"], F.lit("]"))
    )
    rows = found.withColumn("text", F.when(changed, masked).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
