"""Registered queries of the text operators, and the SQL some of them are checked against."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import (
    bpe,
    decontaminate,
    licences,
    lines,
    neardup,
    periodic,
    phrases,
    privacy,
    quality,
    repetition,
    secrets,
    substrings,
    tables,
    toxicity,
)

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of the training folds only."""
    docs = tables.read(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fitted(docs, tables.read(spark, sf_dir, "labels")))


@query
def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through the automaton of the word-level vocabulary, and back."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encoded(tables.read(spark, sf_dir, "documents"), path, ids=False)


@query
def op3_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that overlap, substitutions allowed."""
    return decontaminate.contaminated(
        tables.read(spark, sf_dir, "documents"), tables.read(spark, sf_dir, "benchmark")
    )


@query
def op4_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles, similarity of 0.8 or more, one row per document."""
    return neardup.near_duplicates(tables.read(spark, sf_dir, "documents"), width=2, percent=80)


@query
def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents (path: source and id) and all pages (path: host and path)."""
    docs = tables.read(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc:"), F.col("doc_id")).alias("file"),
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"),
        "text",
    )
    pages = tables.read(spark, sf_dir, "pages").select(
        F.concat(F.lit("page:"), F.col("page_id")).alias("file"),
        licences.url_path(F.col("url")).alias("path"),
        F.col("html").alias("text"),
    )
    found = licences.scanned(docs.unionByName(pages))
    number = F.regexp_extract("file", "([0-9]+)$", 1).cast("long")
    return found.select(
        F.when(F.col("file").startswith("doc:"), number).alias("doc_id"),
        F.when(F.col("file").startswith("page:"), number).alias("page_id"),
        "path",
        "licence",
        "score",
        "basis",
        "origin",
    )


@query
def op6_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it, one row per document."""
    return privacy.reported(tables.read(spark, sf_dir, "documents"))


@query
def op7_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of the training folds only."""
    docs = tables.read(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fitted(docs, tables.read(spark, sf_dir, "labels")))


@query
def op8_suffix_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain quality rules and the verdict on repeated substrings, one row per document."""
    return repetition.judged(tables.read(spark, sf_dir, "documents"))


@query
def op9_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, candidates from the trigram index."""
    return secrets.reported(tables.read(spark, sf_dir, "documents"))


@query
def op10_blockwise_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that an earlier document has too, 50 or more in a row."""
    return substrings.deduplicated(tables.read(spark, sf_dir, "documents"))


OP11_SQL = r"""WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS place FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
shared AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
judged AS (SELECT k.*, s.key IS NOT NULL AS gone FROM keyed k LEFT JOIN shared s ON s.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@query
def op11_range_sorted_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten or more documents hold."""
    found = lines.deduplicated(tables.read(spark, sf_dir, "documents"), least_docs=10, least_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op11_range_sorted_line_dedup"] = OP11_SQL

OP12_SQL = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS d, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
f AS (SELECT lang, d, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE d = 1 GROUP BY lang),
cut AS (
  SELECT lang, d, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS lp,
    array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rp
  FROM f, (VALUES (1), (2)) c(k) WHERE d >= 2 AND k < d AND f >= 10),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r, (1000000 * c.a * c.a) // (x.f * y.f) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.d = c.k AND x.phrase = c.lp
  JOIN f y ON y.lang = c.lang AND y.d = c.d - c.k AND y.phrase = c.rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, d, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(string_split(phrase, ' ')[:2], ' ') AS phrase FROM best WHERE d = 3
    UNION ALL SELECT lang, a, array_to_string(string_split(phrase, ' ')[2:], ' ') FROM best WHERE d = 3)
  GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON b.d = 2 AND i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000"""


@query
def op12_fm_index_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of two and three words of each language."""
    return phrases.collocations(
        tables.read(spark, sf_dir, "documents"), least=10, longest=3, absorb_percent=50, top=2000
    )


SQL["op12_fm_index_phrases"] = OP12_SQL


def periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's rewriting of one text in ten: from word a on, every p words come again."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


@query
def op13_sparse_diagonal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, one text in ten made periodic first."""
    found = periodic.detected(tables.read(spark, sf_dir, "documents"), rewrite=periodic_tail)
    ranked = F.transform("runs", lambda x: F.struct(x["length"].alias("size"), -x["start"], -x["period"], x.alias("run")))
    best = F.array_max(ranked)["run"]
    listed = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
