"""Text, sentiment, summary and topic-model stages."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.functions import text as X
from broadsheet.operators import corpus, enrich, models, topics
from broadsheet.plans import sqlparts as Q
from broadsheet.plans.registry import query
from broadsheet.schemas import (
    BATCH_ERROR_MODEL_NAME,
    BATCH_ERROR_PREFIX,
    SENTIMENT_LABELS,
    SKIPPED_MODEL_NAME,
    SKIPPED_MODEL_TYPE,
)
from broadsheet.session import fresh_path, shared_dir, spread
from broadsheet.sources import tables as TB

NOW = TB.AS_OF
LONG_SQL = f"length({Q.strip_sql('content')}) >= 100"


def tokenizer(text):
    return X.letter_tokens(text, stopwords=Q.STOPWORDS)


def raw(spark, sf_dir):
    return spread(TB.articles(spark, sf_dir), "doc_id")


@query(
    "clean_text",
    "SELECT doc_id, trim(regexp_replace(text, '[^가-힣a-zA-Z]+', ' ', 'g')) AS cleaned FROM documents",
)
def clean_text(spark, sf_dir):
    docs = spread(TB.table(spark, sf_dir, "documents"), "doc_id")
    return docs.select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))


@query(
    "tokenize_docs",
    f"SELECT doc_id, array_to_string({Q.tokens_sql('text', Q.STOPWORDS)}, ' ') AS tokens FROM documents",
)
def tokenize_docs(spark, sf_dir):
    docs = spread(TB.table(spark, sf_dir, "documents"), "doc_id")
    return docs.select("doc_id", F.array_join(tokenizer(F.col("text")), " ").alias("tokens"))


@query(
    "doc_keywords",
    f"WITH {Q.keyword_ctes()} SELECT url, array_to_string(keywords, ' ') AS keywords FROM kw",
)
def doc_keywords(spark, sf_dir):
    df = TB.with_keywords(TB.articles(spark, sf_dir), Q.STOPWORDS)
    return df.select("url", F.array_join("keywords", " ").alias("keywords"))


@query(
    "term_frequencies",
    f"WITH {Q.keyword_ctes()} SELECT doc_id, t AS token, n AS frequency, p - 1 AS first_position FROM tf",
)
def term_frequencies(spark, sf_dir):
    counts = X.term_counts(tokenizer(F.col("content")))
    return raw(spark, sf_dir).select("doc_id", F.explode(counts).alias("t")).select(
        "doc_id",
        F.col("t.token").alias("token"),
        (-F.col("t.neg_count")).cast("bigint").alias("frequency"),
        F.col("t.first_pos").cast("bigint").alias("first_position"),
    )


@query(
    "text_stage",
    f"""WITH {Q.keyword_ctes()} SELECT url, title, content, press, category, published_at, collected_at,
      array_to_string(keywords, ' ') AS keywords, {Q.NOW} AS processed_at FROM kw""",
)
def text_stage(spark, sf_dir):
    staged = enrich.text_stage(raw(spark, sf_dir), NOW, stopwords=Q.STOPWORDS)
    return staged.select(
        "url",
        "title",
        "content",
        "press",
        "category",
        "published_at",
        "collected_at",
        F.array_join("keywords", " ").alias("keywords"),
        "processed_at",
    )


SENTENCES_SQL = r"list_filter(regexp_split_to_array(content, '[.!?]+(\s+|$)'), lambda s: trim(s) <> '')"


@query("sentence_count", f"WITH {Q.ARTICLES} SELECT doc_id, CAST(len({SENTENCES_SQL}) AS BIGINT) AS sentences FROM articles")
def sentence_count(spark, sf_dir):
    return raw(spark, sf_dir).select("doc_id", X.sentence_count(F.col("content")).alias("sentences"))


_WORDS_SQL = r"list_filter(regexp_split_to_array(content, '\s+'), lambda w: w <> '')"
_CHUNKS_SQL = f"""{Q.ARTICLES},
w AS (SELECT doc_id, content, {_WORDS_SQL} AS words FROM articles),
packed AS (SELECT doc_id, CASE WHEN length(content) > 2048 AND len(words) > 512
    THEN list_transform(range(0, CAST(ceil(len(words) / 512.0) AS BIGINT)),
      lambda k: array_to_string(words[k * 512 + 1 : k * 512 + 512], ' '))
    ELSE [content] END AS chunks FROM w),
chunks AS (SELECT doc_id, unnest(chunks) AS chunk, generate_subscripts(chunks, 1) - 1 AS chunk_no FROM packed)"""


@query("chunk_docs", f"WITH {_CHUNKS_SQL} SELECT doc_id, chunk_no, chunk FROM chunks")
def chunk_docs(spark, sf_dir):
    rows = enrich.chunk_rows(raw(spark, sf_dir).select("doc_id", "content"))
    return rows.withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


@query(
    "chunk_sentiment_avg",
    f"""WITH {_CHUNKS_SQL}, s AS (
      SELECT doc_id, CAST(length(chunk) % 3 = 0 AS DOUBLE) AS negative, CAST(length(chunk) % 3 = 1 AS DOUBLE) AS neutral,
        CAST(length(chunk) % 3 = 2 AS DOUBLE) AS positive FROM chunks),
    m AS (SELECT doc_id, avg(negative) AS negative, avg(neutral) AS neutral, avg(positive) AS positive,
        count(*) AS chunks FROM s GROUP BY doc_id)
    SELECT doc_id, round(negative, 4) AS negative, round(neutral, 4) AS neutral, round(positive, 4) AS positive, chunks,
      CASE WHEN negative >= neutral AND negative >= positive THEN 'negative'
           WHEN neutral >= positive THEN 'neutral' ELSE 'positive' END AS sentiment FROM m""",
)
def chunk_sentiment_avg(spark, sf_dir):
    # The length of a chunk stands for a classifier: it puts all weight on one label.
    chunks = enrich.chunk_rows(raw(spark, sf_dir).select("doc_id", "content"))
    scored = chunks.select(
        "doc_id",
        *[
            (F.length("chunk") % 3 == i).cast("double").alias(label)
            for i, label in enumerate(SENTIMENT_LABELS)
        ],
    )
    means = enrich.mean_chunk_scores(scored, "doc_id", list(SENTIMENT_LABELS))
    return means.select("doc_id", *[F.round(c, 4).alias(c) for c in SENTIMENT_LABELS], "chunks", "sentiment")


def stored_sentiment_model(spark, sf_dir):
    """The stored classifier of a folder of tables, fitted and stored where there is none yet."""
    folder = f"{shared_dir(spark)}/models/sentiment-{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}"
    if not models.published(spark, folder):
        models.publish(models.train_sentiment(TB.labelled(spark, sf_dir, how="inner")), folder)
    return models.latest(spark, folder)


@query("sentiment_stage")
def sentiment_stage(spark, sf_dir):
    model = stored_sentiment_model(spark, sf_dir)
    analysed = models.analyse_sentiment(raw(spark, sf_dir), model, NOW)
    scores = F.col("sentiment_analysis.overall_sentiment.scores")
    return analysed.select(
        "url", S.label_of().alias("sentiment"), *[scores[x].alias(x) for x in SENTIMENT_LABELS], "sentiment_processed_at"
    )


@query(
    "sentiment_default",
    f"""WITH {Q.ARTICLES} SELECT url, coalesce(sentiment, 'neutral') AS sentiment,
      CAST(coalesce(sentiment, 'neutral') = 'negative' AS DOUBLE) AS negative,
      CAST(coalesce(sentiment, 'neutral') = 'neutral' AS DOUBLE) AS neutral,
      CAST(coalesce(sentiment, 'neutral') = 'positive' AS DOUBLE) AS positive,
      CASE WHEN sentiment IS NULL THEN 'no score' END AS error, {Q.NOW} AS sentiment_processed_at FROM articles""",
)
def sentiment_default(spark, sf_dir):
    scored = TB.labelled(spark, sf_dir).drop("sentiment_analysis")
    staged = enrich.sentiment_or_default(scored, S.one_hot(F.col("sentiment")), NOW)
    scores = F.col("sentiment_analysis.overall_sentiment.scores")
    return staged.select(
        "url",
        S.label_of().alias("sentiment"),
        *[scores[x].alias(x) for x in SENTIMENT_LABELS],
        F.col("sentiment_analysis.error").alias("error"),
        "sentiment_processed_at",
    )


@query(
    "sentiment_flat_records",
    f"""WITH {Q.ARTICLES} SELECT url, sentiment, CASE WHEN sentiment IS NOT NULL THEN 1.0::DOUBLE END AS own_score
    FROM articles""",
)
def sentiment_flat_records(spark, sf_dir):
    # Some writers store label and scores flat; the reader brings both shapes together.
    df = TB.labelled(spark, sf_dir)
    flat = F.col("lang") == "en"
    scores = F.col("sentiment_analysis.overall_sentiment.scores")
    nested = F.when(~flat, F.col("sentiment_analysis"))
    record = S.nested_form(F.when(flat, S.label_of()), F.when(flat, scores), nested)
    repaired = df.withColumn("sentiment_analysis", record)
    label = S.label_of()
    return repaired.select("url", label.alias("sentiment"), F.try_element_at(scores, label).alias("own_score"))


@query("sentiment_keywords")
def sentiment_keywords(spark, sf_dir):
    model = stored_sentiment_model(spark, sf_dir)
    found = models.sentiment_words(raw(spark, sf_dir), model)
    return found.select("url", *[F.array_join(x, " ").alias(x) for x in SENTIMENT_LABELS])


def length_rule():
    """A stand-in for an external model: the length of a chunk decides its label."""
    return lambda chunks: [[float(len(chunk) % 3 == i) for i in range(3)] for chunk in chunks]


_BLANK_SQL = f"{Q.strip_sql('content')} = ''"
EXTERNAL_SQL = f"""WITH {_CHUNKS_SQL}, m AS (
      SELECT doc_id, avg(CAST(length(chunk) % 3 = 0 AS DOUBLE)) AS a, avg(CAST(length(chunk) % 3 = 1 AS DOUBLE)) AS b,
        avg(CAST(length(chunk) % 3 = 2 AS DOUBLE)) AS c FROM chunks GROUP BY doc_id),
    s AS (SELECT url, coalesce({_BLANK_SQL}, true) AS blank, a, b, c FROM articles JOIN m USING (doc_id))
    SELECT url, CASE WHEN blank THEN 'neutral' WHEN a >= b AND a >= c THEN 'negative' WHEN b >= c THEN 'neutral'
        ELSE 'positive' END AS sentiment,
      CASE WHEN blank THEN 0.0 ELSE round(a, 4) END AS negative, CASE WHEN blank THEN 1.0 ELSE round(b, 4) END AS neutral,
      CASE WHEN blank THEN 0.0 ELSE round(c, 4) END AS positive, CASE WHEN blank THEN 'missing content' END AS error FROM s"""


def sentiment_columns(analysed):
    scores = F.col("sentiment_analysis.overall_sentiment.scores")
    return analysed.select(
        "url",
        S.label_of().alias("sentiment"),
        *[F.round(scores[x], 4).alias(x) for x in SENTIMENT_LABELS],
        F.col("sentiment_analysis.error").alias("error"),
    )


@query("sentiment_external_model", EXTERNAL_SQL)
def sentiment_external_model(spark, sf_dir):
    return sentiment_columns(models.analyse_sentiment_with(raw(spark, sf_dir), length_rule, NOW))


@query(
    "summary_gate",
    f"WITH {Q.ARTICLES} SELECT doc_id, {LONG_SQL} AS long_enough, length({Q.strip_sql('content')}) AS stripped FROM articles",
)
def summary_gate(spark, sf_dir):
    return TB.articles(spark, sf_dir).select(
        "doc_id",
        enrich.long_enough(F.col("content")).alias("long_enough"),
        F.length(X.strip_space(F.col("content"))).cast("bigint").alias("stripped"),
    )


def _info_columns(df):
    info = F.col("summary_info")
    return df.select(
        "url",
        info["summary"].alias("summary"),
        info["original_length"].alias("original_length"),
        info["summary_length"].alias("summary_length"),
        info["sentence_count"].alias("sentence_count"),
        info["compression_ratio"].alias("compression_ratio"),
        info["model_info"]["name"].alias("model_name"),
        info["model_info"]["type"].alias("model_type"),
    )


def _info_sql(ctes: str, summary: str, name: str, kind: str, table: str) -> str:
    count = SENTENCES_SQL.replace("content", "summary")
    return f"""WITH {ctes}, made AS (
      SELECT url, content, {LONG_SQL} AS ok, CASE WHEN {LONG_SQL} THEN {summary} ELSE content END AS summary FROM {table})
    SELECT url, summary, length(content) AS original_length, length(summary) AS summary_length,
      CAST(len({count}) AS BIGINT) AS sentence_count,
      CASE WHEN NOT ok THEN 1.0 ELSE round(length(summary) / length(content), 4) END AS compression_ratio,
      CASE WHEN ok THEN '{name}' ELSE '{SKIPPED_MODEL_NAME}' END AS model_name,
      CASE WHEN ok THEN '{kind}' ELSE '{SKIPPED_MODEL_TYPE}' END AS model_type FROM made"""


@query("summary_info", _info_sql(Q.ARTICLES, f"trim({SENTENCES_SQL}[1])", "lead sentence", "extractive", "articles"))
def summary_info(spark, sf_dir):
    content = F.col("content")
    lead = F.trim(F.get(X.sentences_of(content), F.lit(0)))
    record = enrich.summary_record(content, lead, "lead sentence", "extractive", ~enrich.long_enough(content))
    return _info_columns(raw(spark, sf_dir).withColumn("summary_info", record))


_TOKEN_SHARE = f"len(list_filter(toks, lambda x: list_contains(keywords, x))) / len(toks)"
_EXTRACTIVE_CTES = f"""{Q.keyword_ctes(stop=())},
s AS (SELECT doc_id, keywords, unnest({SENTENCES_SQL}) AS sentence,
    generate_subscripts({SENTENCES_SQL}, 1) AS pos FROM kw WHERE {LONG_SQL}),
st AS (SELECT doc_id, keywords, sentence, pos, {Q.tokens_sql('sentence')} AS toks,
    len(list_filter(regexp_split_to_array(sentence, '\\s+'), lambda w: w <> '')) AS words FROM s),
sc AS (SELECT doc_id, sentence, pos, words,
    CASE WHEN len(toks) = 0 THEN 0.0 ELSE {_TOKEN_SHARE} END AS score FROM st),
cum AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS used FROM sc),
summaries AS (SELECT doc_id, string_agg(trim(sentence), '. ' ORDER BY pos) AS made FROM cum
    WHERE used <= 150 OR used - words < 30 GROUP BY doc_id),
summed AS (SELECT kw.*, made FROM kw LEFT JOIN summaries USING (doc_id))"""


@query(
    "summary_stage",
    _info_sql(_EXTRACTIVE_CTES, "made", enrich.EXTRACTIVE_NAME, enrich.EXTRACTIVE_TYPE, "summed"),
)
def summary_stage(spark, sf_dir):
    return _info_columns(enrich.summary_stage(TB.with_keywords(TB.articles(spark, sf_dir)), NOW))


@query(
    "summary_errors",
    f"""WITH {Q.ARTICLES} SELECT url, '{BATCH_ERROR_PREFIX}model offline' AS summary, 0 AS sentence_count,
      '{BATCH_ERROR_MODEL_NAME}' AS model_name FROM articles WHERE {LONG_SQL}""",
)
def summary_errors(spark, sf_dir):
    def load_model():
        def summarise(texts):
            raise RuntimeError("model offline")

        return summarise

    articles = raw(spark, sf_dir).select("url", "content")
    tried = enrich.summarize_with(articles, load_model, "external", "abstractive", NOW)
    return _info_columns(enrich.summary_failures(tried)).select("url", "summary", "sentence_count", "model_name")


@query(
    "sink_reshape_summary",
    f"""WITH {Q.ARTICLES} SELECT url, CASE WHEN {LONG_SQL} THEN trim({SENTENCES_SQL}[1]) ELSE content END AS summary,
      content AS processed_content FROM articles""",
)
def sink_reshape_summary(spark, sf_dir):
    content = F.col("content")
    lead = F.trim(F.get(X.sentences_of(content), F.lit(0)))
    record = enrich.summary_record(content, lead, "lead sentence", "extractive", ~enrich.long_enough(content))
    stored = enrich.stored_summary(raw(spark, sf_dir).withColumn("summary_info", record))
    return stored.select("url", "summary", "processed_content")


@query("topics_lda")
def topics_lda(spark, sf_dir):
    docs = TB.with_keywords(TB.articles(spark, sf_dir), Q.STOPWORDS).select("url", "keywords")
    analysed = models.topic_model(docs)
    topic = F.col("topic_analysis")
    return analysed.select(
        "url",
        F.array_join(F.transform(topic["main_topics"], lambda t: t.cast("string")), ",").alias("main_topics"),
        F.round(F.array_max(topic["topic_distribution"]), 4).alias("best_share"),
        F.array_join(
            F.try_element_at(topic["topic_keywords"], F.get(topic["main_topics"], F.lit(0)).cast("string")), " "
        ).alias("best_words"),
    )


# --- corpus weights ------------------------------------------------------------

_IDF_CTES = f"""{Q.keyword_ctes(stop=())},
dt AS (SELECT doc_id, unnest(list_distinct(list_transform({Q.tokens_sql('content')}, lambda x: substr(md5(x), 1, 4)))) AS slot FROM kw),
total AS (SELECT count(*) AS n FROM kw),
idf AS (SELECT slot, CAST(floor(1000 * ln((any_value(total.n) + 1.0) / (count(*) + 1.0))) AS BIGINT) AS w FROM dt, total GROUP BY slot),
s AS (SELECT doc_id, unnest({SENTENCES_SQL}) AS sentence, generate_subscripts({SENTENCES_SQL}, 1) AS pos FROM kw WHERE {LONG_SQL}),
st AS (SELECT doc_id, sentence, pos, {Q.tokens_sql('sentence')} AS toks,
    len(list_filter(regexp_split_to_array(sentence, '\\s+'), lambda w: w <> '')) AS words FROM s),
scored AS (SELECT t.doc_id, t.pos, sum(idf.w) / count(*) AS score
    FROM (SELECT doc_id, pos, substr(md5(unnest(toks)), 1, 4) AS slot FROM st) t JOIN idf USING (slot) GROUP BY t.doc_id, t.pos),
sc AS (SELECT st.doc_id, sentence, st.pos, words, coalesce(score, 0.0) AS score FROM st LEFT JOIN scored USING (doc_id, pos)),
cum AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS used FROM sc),
summaries AS (SELECT doc_id, string_agg(trim(sentence), '. ' ORDER BY pos) AS made FROM cum
    WHERE used <= 150 OR used - words < 30 GROUP BY doc_id),
summed AS (SELECT kw.*, made FROM kw LEFT JOIN summaries USING (doc_id))"""


@query("summary_corpus_idf", _info_sql(_IDF_CTES, "made", "corpus-idf", enrich.EXTRACTIVE_TYPE, "summed"))
def summary_corpus_idf(spark, sf_dir):
    """Sentences by the mean weight of their words over the corpus, from a stored table of frequencies."""
    path = fresh_path(spark, "frequencies")
    articles = TB.articles(spark, sf_dir)
    corpus.write_frequencies(articles, path)
    score = corpus.mean_weight(corpus.load_weights(spark, path))
    none = articles.withColumn("keywords", F.array().cast("array<string>"))
    return _info_columns(enrich.summary_stage(none, NOW, score=score, name="corpus-idf"))


# --- topics from anchor words ----------------------------------------------------

_PAIRS = f"""{Q.keyword_ctes()},
lists_ AS (SELECT doc_id, list_distinct(keywords) AS ks FROM kw),
terms AS (SELECT term, count(*) AS n FROM (SELECT unnest(ks) AS term FROM lists_) GROUP BY term
    HAVING count(*) >= 0.01 * (SELECT count(*) FROM kw)),
held AS (SELECT l.doc_id, t.term FROM (SELECT doc_id, unnest(ks) AS term FROM lists_) l JOIN terms t USING (term)),
pairs AS (SELECT x.term AS a, y.term AS b, count(*) AS n FROM held x JOIN held y ON x.doc_id = y.doc_id AND x.term < y.term GROUP BY ALL)"""


def _anchor_ctes(k: int) -> str:
    """Rows of shares, and per topic the longest row and what is left of all rows beside it."""
    steps = [
        """both_ AS (SELECT a AS t, b AS i, n FROM pairs UNION ALL SELECT b, a, n FROM pairs),
r0 AS (SELECT x.t, y.i, coalesce(b.n, 0)::DOUBLE / x.total AS v
  FROM (SELECT t, sum(n) AS total FROM both_ GROUP BY t) x, (SELECT DISTINCT i FROM both_) y
  LEFT JOIN both_ b ON b.t = x.t AND b.i = y.i)"""
    ]
    for j in range(k):
        steps.append(
            f"""a{j} AS (SELECT t, sqrt(sum(v * v)) AS size FROM r{j} GROUP BY t ORDER BY round(sum(v * v), 12) DESC, t LIMIT 1),
u{j} AS (SELECT i, v / size AS u FROM r{j} JOIN a{j} USING (t)),
d{j} AS (SELECT t, sum(v * u) AS d FROM r{j} JOIN u{j} USING (i) GROUP BY t),
r{j + 1} AS MATERIALIZED (SELECT t, i, v - d * u AS v FROM r{j} JOIN u{j} USING (i) JOIN d{j} USING (t))"""
        )
    return ",\n".join(steps)


def topic_docs(spark, sf_dir):
    return TB.with_keywords(TB.articles(spark, sf_dir), Q.STOPWORDS).select("url", "keywords")


@query("topic_cooccurrence", f"WITH {_PAIRS} SELECT a, b, n FROM pairs")
def topic_cooccurrence(spark, sf_dir):
    docs = topic_docs(spark, sf_dir)
    return topics.cooccurrence(docs, [t for t, _ in topics.vocabulary(docs)])


@query("topic_anchors", f"WITH {_PAIRS}, {_anchor_ctes(5)} " + " UNION ALL ".join(f"SELECT {j} AS topic, t AS term FROM a{j}" for j in range(5)))
def topic_anchors(spark, sf_dir):
    path = fresh_path(spark, "topics")
    topics.save(spark, topics.fit(topic_docs(spark, sf_dir)), path)
    return spark.read.parquet(path).where("anchor IS NOT NULL").select(F.col("anchor").alias("topic"), "term")


@query("topics_anchored")
def topics_anchored(spark, sf_dir):
    """Topic shares of every article from a stored anchor-word model."""
    path = fresh_path(spark, "topics")
    docs = topic_docs(spark, sf_dir)
    topics.save(spark, topics.fit(docs), path)
    analysed = topics.analyse(docs, topics.load(spark, path))
    topic = F.col("topic_analysis")
    return analysed.select(
        "url",
        F.array_join(F.transform(topic["main_topics"], lambda t: t.cast("string")), ",").alias("main_topics"),
        F.round(F.array_max(topic["topic_distribution"]), 6).alias("best_share"),
        F.array_join(
            F.try_element_at(topic["topic_keywords"], F.get(topic["main_topics"], F.lit(0)).cast("string")), " "
        ).alias("best_words"),
    )
