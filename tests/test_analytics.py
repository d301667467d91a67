from datetime import datetime

from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.operators import enrich, health, keywords, trends
from broadsheet.plans import analytics
from broadsheet.schemas import BATCH_ERROR_MODEL_NAME, SKIPPED_MODEL_NAME

NOW = "2024-01-31 00:00:00"
AT = datetime(2024, 1, 30)


def keyword_rows(spark, lists):
    rows = [(f"u{i}", k, AT) for i, k in enumerate(lists)]
    return spark.createDataFrame(rows, "url string, keywords array<string>, processed_at timestamp_ntz")


def edges(df):
    return sorted((r.source, r.target, r.weight, r.depth) for r in df.collect())


def test_trending_ignores_missing_and_empty(spark):
    df = keyword_rows(spark, [["a", "b"], ["a", ""], None, []])
    assert [tuple(r) for r in keywords.trending(df, NOW).collect()] == [("a", 2), ("b", 1)]


def test_network_counts_repeats_and_lowers_the_query(spark):
    df = keyword_rows(spark, [["a", "b", "b"], ["a", "c"], ["b", "c"]])
    assert edges(keywords.network_edges(df, "A", NOW)) == [("a", "b", 2, 1), ("a", "c", 1, 1)]


def test_network_without_neighbours_or_articles(spark):
    df = keyword_rows(spark, [["a"], ["b", "c"]])

    def nodes(word):
        found = keywords.network_nodes(df, keywords.network_edges(df, word, NOW), word, NOW)
        return sorted((r.id, r.group, r.size) for r in found.collect())

    assert nodes("a") == [("a", 1, 20)]
    assert nodes("b") == [("b", 1, 20), ("c", 2, 11)]
    assert nodes("zz") == []


def test_network_depth_against_a_plain_walk(spark):
    lists = [["a", "b"], ["a", "b", "c"], ["c", "d"], ["d", "e"], ["e", "f"], ["b", "d"]]
    df = keyword_rows(spark, lists)
    for depth in (1, 2, 3):
        frontier, reached, want = {"a"}, {"a"}, []
        for level in range(1, depth + 1):
            found = []
            for s in frontier:
                weights = {}
                for k in lists:
                    if s in k:
                        for t in k:
                            if t != s:
                                weights[t] = weights.get(t, 0) + 1
                found += [(s, t, w, level) for t, w in sorted(weights.items(), key=lambda x: (-x[1], x[0]))[:2]]
            want += found
            frontier = {t for _, t, _, _ in found} - reached
            reached |= frontier
        assert edges(keywords.network_edges(df, "a", NOW, depth=depth, per_node=2)) == sorted(want)


def test_scores_count_documents_once(spark):
    df = keyword_rows(spark, [["a", "a", "b"], ["a"], []])
    rows = {r.keyword: (r["count"], r.doc_count, r.total_articles) for r in keywords.keyword_scores(df, NOW).collect()}
    assert rows == {"a": (3, 2, 2), "b": (1, 1, 2)}


def labelled(spark, rows):
    df = spark.createDataFrame(rows, "category string, label string, published_at timestamp_ntz")
    return df.withColumn("sentiment_analysis", S.analysis(S.one_hot(F.col("label"))))


def test_summary_total_counts_unknown_categories(spark):
    df = labelled(spark, [("it", "positive", AT), ("sports", None, AT), ("it", None, datetime(2023, 1, 1))])
    rows = {r.category: (r.article_count, r.positive, r.neutral) for r in trends.stats_summary(df, NOW).collect()}
    assert rows == {None: (2, 1, 0), "it": (1, 1, 0)}


def test_empty_input_gives_zeros_and_no_points(spark):
    df = labelled(spark, [])
    assert trends.sentiment_distribution(df, NOW).first().asDict() == {"negative": 0, "neutral": 0, "positive": 0}
    assert trends.timeline(df, NOW).count() == 0


def test_flat_and_nested_records_become_one_shape(spark):
    df = spark.createDataFrame([("positive", {"positive": 0.9})], "l string, s map<string,double>")
    none = F.lit(None).cast("struct<overall_sentiment:struct<sentiment:string,scores:map<string,double>>,error:string>")
    got = df.select(S.nested_form(F.col("l"), F.col("s"), none).alias("r")).first().r
    assert got.overall_sentiment.sentiment == "positive" and got.overall_sentiment.scores == {"positive": 0.9}


def test_sentiment_default_states_the_reason(spark):
    df = spark.createDataFrame([("text", None), (" ", [1.0, 0.0, 0.0]), ("t", [1.0, 0.0, 0.0])], "content string, s array<double>")
    rows = enrich.sentiment_or_default(df, F.col("s"), NOW).select(
        S.label_of().alias("label"), "sentiment_analysis.error"
    ).collect()
    assert [tuple(r) for r in rows] == [("neutral", "no score"), ("neutral", "missing content"), ("negative", None)]


def test_external_summaries_fail_by_batch_only(spark):
    def load():
        def model(texts):
            if any("bad" in t for t in texts):
                raise ValueError("cannot read")
            return [t[:10] for t in texts]

        return model

    texts = ["good " * 30, "bad " * 30, "short", None]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "url string, content string").coalesce(1)
    rows = enrich.summarize_with(df, load, "m", "t", NOW, batch_size=1).orderBy("url").collect()
    infos = [r.summary_info for r in rows]
    assert infos[0].summary == "good good " and infos[0].compression_ratio == round(10 / 150, 4)
    assert infos[1].summary == "Error during batch summarization: cannot read"
    assert infos[1].model_info.name == BATCH_ERROR_MODEL_NAME and infos[1].sentence_count == 0
    assert infos[2].summary == "short" and infos[2].compression_ratio == 1.0
    assert infos[2].model_info.name == infos[3].model_info.name == SKIPPED_MODEL_NAME
    assert infos[3].summary == "" and infos[3].original_length == 0


def test_health_states(spark):
    def status(rows):
        runs = spark.createDataFrame(rows, "run_id string, ts timestamp_ntz, status string")
        return health.freshness(runs, NOW).first().status

    assert status([]) == "warning"
    assert status([("1", AT, "failed"), ("2", datetime(2024, 1, 30, 12), "success")]) == "success"
    assert status([("1", AT, "failed")]) == "error"
    assert status([("1", datetime(2024, 1, 29), "success")]) == "warning"
    parts = spark.createDataFrame([("a", "success"), ("b", "warning")], "part string, status string")
    assert health.overall(parts).first().overall_status == "warning"


def test_keyword_scores_read_the_texts_once(spark, sf_dir):
    found = analytics.keyword_scores(spark, sf_dir)
    found.collect()
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
