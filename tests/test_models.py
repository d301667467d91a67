"""Stored models: reload, new versions at a restart, and topics that no layout changes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.operators import corpus, enrich, models, topics
from broadsheet.plans import sqlparts as Q
from broadsheet.schemas import SENTIMENT_LABELS
from broadsheet.sources import tables as TB
from broadsheet.streaming import jobs

NOW = TB.AS_OF


def scores_of(df):
    scores = F.col("sentiment_analysis.overall_sentiment.scores")
    return {tuple(r) for r in df.select("url", S.label_of(), *[scores[x] for x in SENTIMENT_LABELS]).collect()}


def test_a_stored_model_scores_the_same(spark, sf_dir, tmp_path, monkeypatch):
    labelled = TB.labelled(spark, sf_dir, how="inner")
    fitted = models.train_sentiment(labelled, features=512, max_iter=5)
    folder = str(tmp_path)
    with pytest.raises(ValueError):
        models.latest(spark, folder)
    models.publish(fitted, folder)
    articles = TB.articles(spark, sf_dir)
    here = scores_of(models.analyse_sentiment(articles, fitted, NOW))
    monkeypatch.setattr(models, "train_sentiment", None)  # scoring never trains
    assert scores_of(models.analyse_sentiment(articles, models.latest(spark, folder), NOW)) == here
    (tmp_path / "version=2").mkdir()  # a version that is not whole yet
    assert models.published(spark, folder) == [1]


def test_a_stream_takes_a_new_model_up_at_a_restart(spark, sf_dir, tmp_path):
    labelled = TB.labelled(spark, sf_dir, how="inner")
    first = models.train_sentiment(labelled, features=256, max_iter=1)
    second = models.train_sentiment(labelled, features=512, max_iter=5)
    docs = TB.table(spark, sf_dir, "documents")
    source, folder, out = str(tmp_path / "in"), str(tmp_path / "m"), str(tmp_path / "out")
    parts = [docs.where("doc_id < 100"), docs.where("doc_id >= 100")]
    for part, model in zip(parts, (first, second), strict=True):
        part.coalesce(1).write.mode("append").parquet(source)
        models.publish(model, folder)
        stream = TB.as_articles(jobs.read_folder_stream(spark, source))
        jobs.sentiment_job(stream, folder, out, str(tmp_path / "cp"), NOW)
    want = set()
    for part, model in zip(parts, (first, second), strict=True):
        want |= scores_of(models.analyse_sentiment(TB.as_articles(part), model, NOW))
    assert scores_of(spark.read.parquet(out)) == want


def test_topics_do_not_depend_on_layout(spark, sf_dir, tmp_path):
    docs = TB.with_keywords(TB.articles(spark, sf_dir), Q.STOPWORDS).select("url", "keywords").cache()
    found = []
    for layout in (docs.coalesce(1), docs.repartition(2), docs.repartition(7), docs.orderBy(F.rand(3))):
        model = topics.fit(layout)
        analysed = topics.analyse(layout, model).select("url", "topic_analysis").collect()
        found.append({r.url: repr(r.topic_analysis) for r in analysed})
        assert len(model.anchors) == 5 and np.allclose(model.mixtures.sum(axis=1), 1)
    assert all(f == found[0] for f in found)
    topics.save(spark, model, str(tmp_path))
    again = topics.load(spark, str(tmp_path))
    assert (again.terms, again.anchors) == (model.terms, model.anchors) and (again.mixtures == model.mixtures).all()


def test_topics_find_planted_anchors(spark):
    """Three groups of words, each with one word that stands with no other group."""
    rng = np.random.default_rng(1)
    groups = [[f"{g}{i}" for i in range(6)] for g in "abc"]
    rows = []
    for i in range(600):
        words = list(rng.choice(groups[i % 3], 4, replace=False))
        if i % 4 == 0:
            words += list(rng.choice([w for g in groups for w in g[1:]], 2))
        rows.append((words,))
    df = spark.createDataFrame(rows, "keywords array<string>")
    model = topics.fit(df, k=3)
    assert {a[0] for a in model.anchors} == {"a", "b", "c"}
    best = {t: model.anchors[int(m.argmax())][0] for t, m in zip(model.terms, model.mixtures, strict=True)}
    assert all(t[0] == g for t, g in best.items())
    assert all({w[0] for w in ws[:4]} == {a[0]} for ws, a in zip(model.words(), model.anchors, strict=True))


def test_topics_of_odd_rows(spark):
    df = spark.createDataFrame([(None,), ([],), (["x", "y"],), (["x", "y", "y"],), (["lone"],)], "keywords array<string>")
    model = topics.fit(df, k=2, least_share=0.1)
    assert model.terms == ["x", "y"]
    shares = [r.topic_analysis.topic_distribution for r in topics.analyse(df, model).collect()]
    assert all(abs(sum(s) - 1) < 1e-9 for s in shares)
    assert topics.fit(df.limit(0)).anchors == []


def test_corpus_weights(spark, tmp_path):
    df = spark.createDataFrame([("common rare",), ("common thing",), (None,), ("",)], "content string")
    corpus.write_frequencies(df, str(tmp_path))
    weights = corpus.load_weights(spark, str(tmp_path))
    score = corpus.mean_weight(weights)
    assert score(["common"], set()) == int(1000 * np.log(5 / 3)) and score(["rare"], set()) == int(1000 * np.log(5 / 2))
    assert score(["common", "never"], set()) == (int(1000 * np.log(5 / 3)) + int(1000 * np.log(5))) / 2
    text = "common rare thing. " + "common common common. " * 12 + "rare rare rare."
    made = df.sparkSession.createDataFrame([(text, [])], "content string, keywords array<string>")
    summary = enrich.extractive_summary(F.col("content"), F.col("keywords"), 3, 4, score=score)
    assert made.select(summary).first()[0] == "rare rare rare"


def test_scores_hold_few_rows_at_a_time(spark):
    def one(units):
        return [[1.0, 0.0, 0.0] for _ in units]

    rows = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "units array<string>")
    scored = rows.select(models.unit_scores(F.col("units"), lambda: one).alias("s"))
    assert [r.s.scores for r in scored.collect()] == [[[1.0, 0.0, 0.0]] * 2, None, None]
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "Arrow" not in plan


def test_pairs_sort_a_row_s_terms_once(spark):
    rows = spark.createDataFrame([(["b", "a", "c", "a", "x"],), (["c", "a"],), (None,), ([],)], "keywords array<string>")
    pairs = topics.cooccurrence(rows, ["a", "b", "c"])
    assert {(r.a, r.b): r.n for r in pairs.collect()} == {("a", "b"): 1, ("a", "c"): 2, ("b", "c"): 1}
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("array_sort(") == 1
