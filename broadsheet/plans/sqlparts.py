"""Shared pieces of the reference SQL (DuckDB dialect)."""

from __future__ import annotations

from broadsheet.functions.pages import DROPPED_TAGS, ENTITIES
from broadsheet.schemas import CATEGORIES, SECTIONS
from broadsheet.sources.tables import AS_OF, TOPIC_WORDS

STOPWORDS = ("the", "of", "and", "de", "la", "le", "les", "der", "die", "und", "que", "el")

NOW = f"TIMESTAMP '{AS_OF}'"


def quoted(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def days_ago(days: int) -> str:
    return f"{NOW} - INTERVAL {days} DAY"


ARTICLES = f"""
articles AS (
  SELECT d.doc_id, 'https://example.org/a/' || CAST(d.doc_id AS VARCHAR) AS url,
    split_part(d.text, chr(10), 1) AS title, d.text AS content, d.source AS press,
    ({quoted(CATEGORIES)})[CAST(substr(d.source, 4) AS INT) % 7 + 1] AS category,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((d.doc_id * 37) % 720 AS INT)) AS published_at,
    d.lang, d.n_chars, l.quality, l.toxic,
    CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
         WHEN l.quality = 0 THEN 'neutral' END AS sentiment
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
enriched AS (
  SELECT *, published_at + INTERVAL 10 MINUTE AS collected_at,
    published_at + INTERVAL 1 HOUR AS processed_at FROM articles)"""


def tokens_sql(text: str, stop=()) -> str:
    words = f"string_split(trim(regexp_replace(lower({text}), '[^가-힣a-z]+', ' ', 'g')), ' ')"
    keep = "length(x) > 1" + (f" AND NOT list_contains({quoted(stop)}, x)" if stop else "")
    return f"list_filter({words}, lambda x: {keep})"


def keyword_ctes(stop=STOPWORDS, n: int = 10) -> str:
    return f"""{ARTICLES},
tok AS (
  SELECT doc_id, unnest(toks) AS t, generate_subscripts(toks, 1) AS p
  FROM (SELECT doc_id, {tokens_sql('content', stop)} AS toks FROM enriched)),
tf AS (SELECT doc_id, t, count(*) AS n, min(p) AS p FROM tok GROUP BY doc_id, t),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, p) AS rk FROM tf),
lists AS (SELECT doc_id, list(t ORDER BY rk) AS keywords FROM ranked WHERE rk <= {n} GROUP BY doc_id),
kw AS (
  SELECT e.*, coalesce(l.keywords, []) AS keywords
  FROM enriched e LEFT JOIN lists l ON l.doc_id = e.doc_id)"""


MESSAGES = f"""{ARTICLES},
staged AS (
  SELECT *, (['raw', 'processed', 'sentiment', 'summary'])[list_position(['en', 'fr', 'de', 'es'], lang)] AS stage
  FROM enriched),
messages AS (
  SELECT *, CASE WHEN press = 'src9' THEN 'other.x.raw' WHEN press = 'src7' THEN 'news.sports.' || stage
      ELSE 'news.' || category || '.' || stage END AS topic,
    CASE WHEN toxic = 1 THEN 'malformed json' WHEN quality = 0 THEN 'bad url' END AS reject_reason
  FROM staged)"""


#: What the four stage tables hold after both editions of every article came in.
STAGE_ROWS = f"""{MESSAGES},
stage_rows AS (
  SELECT CASE stage WHEN 'raw' THEN 'news_articles' ELSE stage || '_articles' END AS table_name, url, title,
    press || '-late' AS press, category, published_at, collected_at,
    CASE WHEN doc_id % 5 <> 0 THEN array_to_string(string_split(title, ' ')[:2], ' ') END AS keywords,
    CASE WHEN stage <> 'raw' THEN CASE WHEN doc_id % 4 = 0 THEN {NOW} ELSE processed_at END END AS processed_at,
    CASE WHEN stage = 'sentiment' THEN sentiment END AS sentiment,
    CASE WHEN stage = 'summary' THEN title END AS summary
  FROM messages WHERE topic LIKE 'news.%' AND reject_reason IS NULL AND (stage <> 'summary' OR n_chars % 7 <> 0))"""


TOPICS = f"""{ARTICLES},
topics AS (
  SELECT *, list_distinct([CAST(doc_id % 5 AS INT), CAST(n_chars % 5 AS INT)]) AS main_topics FROM enriched),
words AS (SELECT * FROM (VALUES {', '.join(f"({k}, '{','.join(v)}')" for k, v in TOPIC_WORDS.items())}) w(topic, keywords))"""

SECTION_ROWS = f"""sections AS (
  SELECT * FROM (VALUES {', '.join(f"({i}, '{a}', '{b}', '{c}')" for i, (a, b, c) in enumerate(SECTIONS))})
  s(position, site, section, section_category))"""


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def text_of_sql(x: str) -> str:
    x = f"regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), '(?s)<[^>]+>', '', 'g')"
    for entity, char in ENTITIES:
        literal = char.replace("'", "''")
        x = f"regexp_replace({x}, '{entity}', '{literal}', 'g')"
    return strip_sql(x)


def inner_sql(tag: str, html: str = "html") -> str:
    return rf"regexp_extract({html}, '(?is)<{tag}\b[^>]*>(.*?)</{tag}>', 1)"


def drop_blocks_sql(x: str) -> str:
    for tag in DROPPED_TAGS:
        x = rf"regexp_replace({x}, '(?is)<{tag}\b[^>]*>.*?</{tag}>', '', 'g')"
    return rf"""regexp_replace({x}, '(?is)<div class="ad"[^>]*>.*?</div>', '', 'g')"""


PAGE_TITLE = f"coalesce(nullif({text_of_sql(inner_sql('h1'))}, ''), nullif({text_of_sql(inner_sql('title'))}, ''))"
PAGE_CONTENT = f"nullif({text_of_sql(drop_blocks_sql(inner_sql('article')))}, '')"
PAGE_HOST = r"regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"
PAGE_PRESS = rf"""coalesce(nullif(regexp_extract(html, '(?i)<img\b[^>]*\btitle="([^"]*)"', 1), ''), {PAGE_HOST})"""

PAGE_ARTICLES = f"""page_articles AS (
  SELECT * FROM (SELECT page_id, url, {PAGE_TITLE} AS title, {PAGE_CONTENT} AS content, {PAGE_PRESS} AS press FROM pages)
  WHERE title IS NOT NULL AND content IS NOT NULL)"""

CHANGES = f"""{ARTICLES},
changes AS (
  SELECT url, title || ' (first edition)' AS title, press, sentiment, 1 AS ingest_seq FROM articles WHERE quality IS NOT NULL
  UNION ALL
  SELECT url, title || ' (late edition)', CASE WHEN toxic = 0 THEN press END, sentiment, 2 FROM articles WHERE quality IS NOT NULL
  UNION ALL
  SELECT url, {PAGE_TITLE}, {PAGE_HOST}, CAST(NULL AS VARCHAR), 1 FROM pages),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ingest_seq DESC) AS rk FROM changes) WHERE rk = 1)"""
