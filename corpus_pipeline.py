"""From raw documents to tokens: five stages, each a table that the next one reads.

toxicity drops documents that the classifier rejects; near_duplicates keeps the smallest id of
each group (five-word shingles, similarity 0.8); decontamination drops documents that overlap a
benchmark item; secrets replaces each secret by its rule's name; tokens encodes the texts.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import broadsheet
from broadsheet.llm import bpe, decontaminate, neardup, secrets, tables, toxicity

# Python workers may not have this folder on their path; send the package's functions along.
cloudpickle.register_pickle_by_value(broadsheet)


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is not among ``ids`` (one column, doc_id); null ids stay."""
    gone = ids.select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone.hint("shuffle_hash"), F.col("doc_id") == F.col("gone"), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fitted(docs, tables.read(spark, sf_dir, "labels"))
    return without(docs, toxicity.scored(docs, model).filter("predicted = 1"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, neardup.near_duplicates(docs, width=5, percent=80).filter(~F.col("kept")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, decontaminate.contaminated(docs, tables.read(spark, sf_dir, "benchmark")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets masked; n_chars follows the text where it changed."""
    return secrets.redacted(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("tokens", tokens),
]
#: Trained scores, links and tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's rows written and read again."""
    docs = tables.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = tables.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
