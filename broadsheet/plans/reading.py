"""Scans, filters, lookups, search, paging and message sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.functions import pages as P
from broadsheet.functions import predicates as PR
from broadsheet.functions import text as X
from broadsheet.functions import times as TM
from broadsheet.functions import topics as TP
from broadsheet.operators import enrich, ingest, search, store, trends
from broadsheet.plans import sqlparts as Q
from broadsheet.plans.registry import query
from broadsheet.schemas import STAGES
from broadsheet.session import spread
from broadsheet.sources import messages as M
from broadsheet.sources import sites
from broadsheet.sources import tables as TB

CARD = ("url", "title", "press", "category", "published_at")
CARD_SQL = ", ".join(CARD)


def keyworded(spark, sf_dir):
    return TB.with_keywords(TB.labelled(spark, sf_dir), Q.STOPWORDS)


# --- message sources -------------------------------------------------------


def _scan(name, choose, where):
    @query(name, f"WITH {Q.MESSAGES} SELECT doc_id AS message_no, topic FROM messages WHERE {where}")
    def run(spark, sf_dir):
        return choose(TB.messages(spark, sf_dir)).select(F.col("offset").alias("message_no"), "topic")

    return run


_scan(
    "scan_topic_pattern",
    lambda m: M.by_pattern(m, TP.RAW_PATTERN),
    r"regexp_matches(topic, 'news\..*\.raw')",
)
_scan(
    "scan_topic_list",
    lambda m: M.by_topics(m, TP.topic_list("processed")),
    f"topic IN (SELECT 'news.' || c || '.processed' FROM (SELECT unnest({Q.quoted(TB.CATEGORIES)}) AS c))",
)
_scan(
    "scan_topic_allowlist",
    lambda m: M.by_topics(m, TP.topic_list("processed", ["economy", "it", "sports"])),
    "topic IN ('news.economy.processed', 'news.it.processed')",
)
_scan(
    "scan_sink_pattern",
    lambda m: M.by_pattern(m, TP.SINK_PATTERN),
    r"regexp_matches(topic, '^news\.[a-zA-Z0-9_-]+\.(processed|sentiment|summary)$')",
)


@query(
    "replay_batch",
    f"""WITH {Q.MESSAGES} SELECT doc_id AS message_no, url, category, title, length(content) AS content_length,
      CASE WHEN doc_id % 3 <> 0 THEN array_to_string(string_split(title, ' ')[:2], ' ') END AS keywords
    FROM messages WHERE topic = 'news.society.processed' AND reject_reason IS NULL""",
)
def replay_batch(spark, sf_dir):
    topics = TP.topic_list("processed", TP.replay_categories("society"))
    records = M.accepted(M.checked(M.by_topics(TB.messages(spark, sf_dir), topics)))
    return records.select(
        F.col("offset").alias("message_no"),
        "url",
        "category",
        "title",
        F.length("content").cast("bigint").alias("content_length"),
        F.array_join("keywords", " ").alias("keywords"),
    )


@query("decode_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def decode_json(spark, sf_dir):
    events = TB.table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query(
    "validate_articles",
    f"""WITH {Q.MESSAGES} SELECT doc_id AS message_no, topic, url, title, press, category, published_at, collected_at,
      CASE WHEN doc_id % 3 <> 0 THEN array_to_string(string_split(title, ' ')[:2], ' ') END AS keywords
    FROM messages WHERE reject_reason IS NULL""",
)
def validate_articles(spark, sf_dir):
    records = M.accepted(M.checked(TB.messages(spark, sf_dir)))
    listed = records.withColumn("keywords", F.array_join("keywords", " "))
    return listed.drop("content").withColumnRenamed("offset", "message_no")


@query(
    "quarantine_articles",
    f"WITH {Q.MESSAGES} SELECT doc_id AS message_no, topic, reject_reason FROM messages WHERE reject_reason IS NOT NULL",
)
def quarantine_articles(spark, sf_dir):
    rows = M.rejected(M.checked(TB.messages(spark, sf_dir)))
    return rows.select(F.col("offset").alias("message_no"), "topic", "reject_reason")


@query(
    "known_category_only",
    rf"""WITH {Q.MESSAGES} SELECT doc_id AS message_no, topic, c AS category
    FROM (SELECT *, regexp_extract(topic, '^news\.(.*)\.processed$', 1) AS c FROM messages)
    WHERE list_contains({Q.quoted(TB.CATEGORIES)}, c)""",
)
def known_category_only(spark, sf_dir):
    named = TB.messages(spark, sf_dir).withColumn("category", TP.category_between(F.col("topic"), "processed"))
    return named.where(TP.is_known_category(F.col("category"))).select(
        F.col("offset").alias("message_no"), "topic", "category"
    )


@query(
    "category_from_topic",
    f"""WITH {Q.MESSAGES} SELECT doc_id AS message_no,
    coalesce(CASE WHEN lang <> 'en' THEN category END, split_part(topic, '.', 2)) AS category FROM messages""",
)
def category_from_topic(spark, sf_dir):
    # English records come without their category field, as some producers send them.
    own = F.when(F.col("lang") != "en", F.col("category"))
    sent = TB.as_messages(TB.labelled(spark, sf_dir).withColumn("own", own), keep=["own"])
    return sent.withColumnRenamed("own", "category").select(
        F.col("offset").alias("message_no"),
        M.category_or_topic(F.col("category"), F.col("topic")).alias("category"),
    )


# --- table reads -----------------------------------------------------------


@query(
    "find_many",
    f"""WITH {Q.ARTICLES} SELECT {CARD_SQL} FROM articles WHERE n_chars > 1000
    ORDER BY press ASC NULLS FIRST, published_at DESC NULLS LAST, url LIMIT 40 OFFSET 15""",
)
def find_many(spark, sf_dir):
    return store.find_many(
        TB.articles(spark, sf_dir),
        F.col("n_chars") > 1000,
        CARD,
        sort=(("press", 1), ("published_at", -1)),
        skip=15,
        limit=40,
    )


@query(
    "find_one",
    f"WITH {Q.ARTICLES} SELECT {CARD_SQL} FROM articles WHERE press = 'src3' ORDER BY url LIMIT 1",
)
def find_one(spark, sf_dir):
    return store.find_one(TB.articles(spark, sf_dir), F.col("press") == "src3", CARD)


@query("count_articles", f"WITH {Q.ARTICLES} SELECT count(*) AS count FROM articles WHERE category = 'world'")
def count_articles(spark, sf_dir):
    return store.count_rows(TB.articles(spark, sf_dir), F.col("category") == "world")


@query(
    "articles_page",
    f"""WITH {Q.ARTICLES}, hits AS (SELECT * FROM articles WHERE category = 'economy' AND sentiment = 'positive')
    SELECT {CARD_SQL}, (SELECT count(*) FROM hits) AS total FROM hits
    ORDER BY published_at DESC, url LIMIT 20 OFFSET 20""",
)
def articles_page(spark, sf_dir):
    rows = search.list_articles(TB.labelled(spark, sf_dir), category="economy", sentiment="positive", page=2, size=20)
    return rows.select(*CARD, "total")


@query(
    "articles_by_category",
    f"""WITH {Q.ARTICLES} SELECT {CARD_SQL} FROM articles WHERE category = 'it'
    ORDER BY published_at DESC, url LIMIT 10 OFFSET 5""",
)
def articles_by_category(spark, sf_dir):
    return search.by_category(TB.articles(spark, sf_dir), "it", limit=10, skip=5).select(*CARD)


@query(
    "articles_by_sentiment",
    f"""WITH {Q.ARTICLES} SELECT {CARD_SQL}, sentiment FROM articles WHERE sentiment = 'negative'
    ORDER BY published_at DESC, url LIMIT 10""",
)
def articles_by_sentiment(spark, sf_dir):
    return search.by_sentiment(TB.labelled(spark, sf_dir), "negative").select(*CARD, "sentiment")


@query(
    "articles_by_date_range",
    f"""WITH {Q.ARTICLES} SELECT {CARD_SQL} FROM articles
    WHERE published_at BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'""",
)
def articles_by_date_range(spark, sf_dir):
    rows = search.by_date_range(TB.articles(spark, sf_dir), "2024-01-10 00:00:00", "2024-01-12 12:00:00")
    return rows.select(*CARD)


@query(
    "articles_per_category_topn",
    f"""WITH {Q.ARTICLES} SELECT {CARD_SQL}, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY category ORDER BY published_at DESC, url) AS rank FROM articles)
    WHERE rank <= 10""",
)
def articles_per_category_topn(spark, sf_dir):
    return store.newest_per_group(TB.articles(spark, sf_dir), "category", 10).select(*CARD, "rank")


@query(
    "latest_summaries",
    f"""WITH {Q.ARTICLES} SELECT {CARD_SQL} FROM articles
    WHERE length({Q.strip_sql('content')}) >= 100 AND category = 'culture'
    ORDER BY published_at DESC, url LIMIT 10""",
)
def latest_summaries(spark, sf_dir):
    summarised = TB.articles(spark, sf_dir).where(enrich.long_enough(F.col("content")))
    return search.latest_summaries(summarised, "culture").select(*CARD)


# --- search predicates -----------------------------------------------------


def _keyword_query(name, predicate, where):
    @query(name, f"WITH {Q.keyword_ctes()} SELECT url, title FROM kw WHERE {where}")
    def run(spark, sf_dir):
        df = TB.with_keywords(TB.articles(spark, sf_dir), Q.STOPWORDS)
        return df.where(predicate(F.col("keywords"))).select("url", "title")

    return run


_keyword_query(
    "search_keywords_any", lambda k: PR.has_any(k, ["is", "des", "sch"]), "list_has_any(keywords, ['is', 'des', 'sch'])"
)
_keyword_query("search_keywords_all", lambda k: PR.has_all(k, ["IS", "On"]), "list_has_all(keywords, ['is', 'on'])")
_keyword_query(
    "search_keywords_none",
    lambda k: PR.has_none(k, ["IS", "des", "in"]),
    "NOT list_has_any(keywords, ['is', 'des', 'in'])",
)


@query(
    "search_title",
    f"""WITH {Q.ARTICLES} SELECT url, title FROM articles
    WHERE contains(lower(title), 'thand') OR contains(lower(title), 'pour')""",
)
def search_title(spark, sf_dir):
    df = TB.articles(spark, sf_dir)
    return df.where(PR.title_matches(F.col("title"), "  THand  pour ")).select("url", "title")


@query(
    "search_text",
    f"""WITH {Q.keyword_ctes()} SELECT url, title FROM kw
    WHERE contains(lower(title), 'thand') OR contains(lower(title), 'sch')
    OR list_has_any(keywords, ['thand', 'sch'])""",
)
def search_text(spark, sf_dir):
    df = TB.with_keywords(TB.articles(spark, sf_dir), Q.STOPWORDS)
    return df.where(PR.text_matches(F.col("title"), F.col("keywords"), "thand Sch")).select("url", "title")


@query(
    "search_articles",
    f"""WITH {Q.keyword_ctes()}, hits AS (
      SELECT * FROM kw
      WHERE (contains(lower(title), 'th') OR contains(lower(title), 'on') OR list_has_any(keywords, ['th', 'on']))
        AND category IN ('economy', 'society', 'it') AND sentiment IN ('positive', 'neutral')
        AND published_at BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-28 00:00:00'
        AND list_has_all(keywords, ['is']) AND NOT list_has_any(keywords, ['des']))
    SELECT {CARD_SQL}, (SELECT count(*) FROM hits) AS total FROM hits ORDER BY published_at DESC, url LIMIT 20""",
)
def search_articles(spark, sf_dir):
    request = search.SearchRequest(
        query="th on",
        categories=["economy", "society", "it"],
        sentiments=["positive", "neutral"],
        start_date="2024-01-02 00:00:00",
        end_date="2024-01-28 00:00:00",
        include_keywords=["is"],
        exclude_keywords=["des"],
    )
    return search.search(keyworded(spark, sf_dir), request).select(*CARD, "total")


# --- lookups ---------------------------------------------------------------


@query(
    "unprocessed_articles",
    f"""WITH {Q.ARTICLES} SELECT url, collected_at FROM enriched
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY collected_at, url LIMIT 100""",
)
def unprocessed_articles(spark, sf_dir):
    raw = TB.articles(spark, sf_dir).select("url", "collected_at")
    processed = TB.labelled(spark, sf_dir, how="inner").select("url")
    return store.unprocessed(raw, processed, 100)


@query(
    "category_display",
    f"""WITH {Q.ARTICLES} SELECT category, display_name, count(*) AS articles
    FROM articles LEFT JOIN (VALUES {', '.join(f"('{k}', '{v}')" for k, v in TB.CATEGORIES.items())})
      names(category, display_name) USING (category) GROUP BY ALL""",
)
def category_display(spark, sf_dir):
    return (
        TB.articles(spark, sf_dir)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("articles"))
        .withColumn("display_name", TP.display_name(F.col("category")))
    )


@query(
    "category_code",
    f"""WITH {Q.ARTICLES} SELECT press, coalesce(display_name, '100') AS code, count(*) AS articles
    FROM (SELECT press, CASE WHEN press = 'src7' THEN 'sports' ELSE category END AS category FROM articles)
    LEFT JOIN (VALUES {', '.join(f"('{k}', '{v}')" for k, v in TB.CATEGORIES.items())})
      names(category, display_name) USING (category) GROUP BY ALL""",
)
def category_code(spark, sf_dir):
    sent = F.when(F.col("press") == "src7", "sports").otherwise(F.col("category"))
    return (
        TB.articles(spark, sf_dir)
        .groupBy("press", TP.category_code(sent).alias("code"))
        .agg(F.count(F.lit(1)).alias("articles"))
    )


@query(
    "section_to_category",
    f"""WITH {Q.ARTICLES}, {Q.SECTION_ROWS}
    SELECT site, section, section_category, count(*) AS articles
    FROM articles JOIN sections ON position = CAST(substr(press, 4) AS INT) GROUP BY ALL""",
)
def section_to_category(spark, sf_dir):
    return (
        ingest.with_section(TB.articles(spark, sf_dir))
        .groupBy("site", "section", "section_category")
        .agg(F.count(F.lit(1)).alias("articles"))
    )


@query(
    "category_list",
    f"""WITH {Q.ARTICLES} SELECT position, n.category, count(a.url) AS article_count
    FROM (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(TB.CATEGORIES))}) n(position, category)
    LEFT JOIN articles a ON a.category = n.category GROUP BY ALL""",
)
def category_list(spark, sf_dir):
    return trends.category_list(TB.articles(spark, sf_dir))


@query(
    "topic_catalog",
    f"""WITH {Q.MESSAGES}
    SELECT c.category, s.stage, 'news.' || c.category || '.' || s.stage AS topic, c.display_name,
      count(m.topic) AS message_count
    FROM (VALUES {', '.join(f"('{k}', '{v}')" for k, v in TB.CATEGORIES.items())}) c(category, display_name)
    CROSS JOIN (VALUES ('raw'), ('processed'), ('sentiment'), ('summary')) s(stage)
    LEFT JOIN messages m ON m.topic = 'news.' || c.category || '.' || s.stage GROUP BY ALL""",
)
def topic_catalog(spark, sf_dir):
    return trends.topic_catalog(TB.messages(spark, sf_dir), STAGES)


@query(
    "stage_coverage",
    f"""WITH {Q.ARTICLES} SELECT url, true AS raw, regexp_matches(content, '[가-힣a-zA-Z]{{2,}}') AS processed,
      quality IS NOT NULL AS sentiment, length({Q.strip_sql('content')}) >= 100 AS summary FROM articles""",
)
def stage_coverage(spark, sf_dir):
    raw = TB.articles(spark, sf_dir)
    return store.stage_coverage(
        {
            "raw": raw,
            "processed": raw.where(F.col("content").rlike(X.LETTER_RUN)),
            "sentiment": TB.labelled(spark, sf_dir, how="inner"),
            "summary": raw.where(enrich.long_enough(F.col("content"))),
        }
    )


# --- pages -----------------------------------------------------------------


@query("extract_articles", f"WITH {Q.PAGE_ARTICLES} SELECT page_id, url, title, content FROM page_articles")
def extract_articles(spark, sf_dir):
    return TB.page_articles(spark, sf_dir).drop("press")


@query("extract_articles_by_site", f"WITH {Q.PAGE_ARTICLES} SELECT page_id, title, content, {Q.NOW} AS published_at FROM page_articles")
def extract_articles_by_site(spark, sf_dir):
    pages = spread(TB.table(spark, sf_dir, "pages"), "page_id")
    return sites.extract_articles(pages, sites.PLAIN_SITE, TB.AS_OF, ["page_id"]).drop("press")


@query(
    "page_links_by_site",
    r"""WITH a AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root,
      (regexp_extract_all(html, '<li><a href="([^"]*)"', 1))[1:3] AS hrefs FROM pages)
    SELECT page_id, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS position FROM a""",
)
def page_links_by_site(spark, sf_dir):
    pages = spread(TB.table(spark, sf_dir, "pages"), "page_id")
    found = sites.extract_links(pages, sites.LinkList("nav li", 3, "a", root="https://site"), ["page_id"], cap=3)
    return found.select(
        "page_id", F.regexp_replace("link", "^https://site", "").alias("href"), F.col("position").cast("bigint").alias("position")
    )


@query("extract_press", f"SELECT page_id, {Q.PAGE_PRESS} AS press FROM pages")
def extract_press(spark, sf_dir):
    host = F.parse_url(F.col("url"), F.lit("HOST"))
    return TB.table(spark, sf_dir, "pages").select("page_id", P.page_press(F.col("html"), host).alias("press"))


_RAW_DATE_SQL = """CASE lang WHEN 'en' THEN strftime(published_at, '%Y-%m-%d %H:%M:%S')
    WHEN 'fr' THEN ' ' || strftime(published_at, '%Y.%m.%d %H:%M') WHEN 'de' THEN 'n/a' END"""


@query(
    "parse_dates",
    f"""WITH {Q.ARTICLES} SELECT doc_id, coalesce(try_strptime(trim(d), '%Y-%m-%d %H:%M:%S'),
      try_strptime(trim(d), '%Y.%m.%d %H:%M'), {Q.NOW}) AS published_at
    FROM (SELECT doc_id, {_RAW_DATE_SQL} AS d FROM articles)""",
)
def parse_dates(spark, sf_dir):
    at = F.col("published_at")
    printed = (
        F.when(F.col("lang") == "en", F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("lang") == "fr", F.concat(F.lit(" "), F.date_format(at, "yyyy.MM.dd HH:mm")))
        .when(F.col("lang") == "de", "n/a")
    )
    return TB.articles(spark, sf_dir).select("doc_id", TM.parse_page_date(printed, TB.AS_OF).alias("published_at"))


def _links(name, cap):
    hrefs = "regexp_extract_all(html, '<a\\b[^>]*>')"
    kept = f"({hrefs})[1:{cap}]" if cap else hrefs

    @query(
        name,
        rf"""WITH a AS (
          SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root,
            list_transform({kept}, lambda x: regexp_extract(x, '\bhref="([^"]*)"', 1)) AS hrefs FROM pages),
        b AS (SELECT page_id, list_filter(list_transform(hrefs, lambda h:
            CASE WHEN starts_with(h, '/') THEN root || h ELSE h END), lambda h: starts_with(h, 'http')) AS links FROM a)
        SELECT page_id, unnest(links) AS link, generate_subscripts(links, 1) - 1 AS position FROM b""",
    )
    def run(spark, sf_dir):
        links = P.page_links(F.col("html"), F.col("url"), cap)
        pages = TB.table(spark, sf_dir, "pages")
        return pages.select("page_id", F.posexplode(links).alias("position", "link")).withColumn(
            "position", F.col("position").cast("bigint")
        )

    return run


_links("page_links", None)
_links("page_links_topn", 4)


# --- scalar functions ------------------------------------------------------


@query(
    "scalar_mix",
    f"""WITH {Q.ARTICLES} SELECT doc_id, lower(title) AS lowered,
      CAST(len(list_filter(regexp_split_to_array(content, '\\s+'), lambda w: w <> '')) AS BIGINT) AS words,
      regexp_replace(press, '[0-9]+', '#') AS masked, regexp_extract(press, '([0-9]+)', 1) AS digits,
      starts_with(url, 'https') AS secure, split_part('news.' || category || '.raw', '.', 2) AS part,
      length({Q.strip_sql('content')}) AS stripped_length, left(content, 50) || '...' AS preview,
      strftime(published_at, '%Y-%m-%dT%H:%M:%S') AS iso_time, strftime(published_at, '%G-%V') AS iso_week,
      published_at - INTERVAL 7 DAY AS week_before,
      CASE WHEN n_chars > 0 THEN round(length(title) / n_chars, 4) ELSE 0.0 END AS ratio,
      CAST(octet_length(encode(title)) AS BIGINT) AS title_bytes,
      coalesce(sentiment, 'unknown') AS label FROM articles""",
)
def scalar_mix(spark, sf_dir):
    title, content, at = F.col("title"), F.col("content"), F.col("published_at")
    return TB.labelled(spark, sf_dir).select(
        "doc_id",
        F.lower(title).alias("lowered"),
        F.size(X.words_of(content)).cast("bigint").alias("words"),
        F.regexp_replace("press", "[0-9]+", "#").alias("masked"),
        F.regexp_extract("press", "([0-9]+)", 1).alias("digits"),
        F.col("url").startswith("https").alias("secure"),
        TP.topic_part(TP.topic_name(F.col("category"), "raw"), 1).alias("part"),
        F.length(X.strip_space(content)).cast("bigint").alias("stripped_length"),
        F.concat(F.substring(content, 1, 50), F.lit("...")).alias("preview"),
        TM.iso(at).alias("iso_time"),
        TM.bucket(at, "week").alias("iso_week"),
        (at - F.expr("INTERVAL 7 DAYS")).alias("week_before"),
        F.when(F.col("n_chars") > 0, F.round(F.length(title) / F.col("n_chars"), 4)).otherwise(0.0).alias("ratio"),
        F.octet_length(title).cast("bigint").alias("title_bytes"),
        F.coalesce("sentiment", F.lit("unknown")).alias("label"),
    )
