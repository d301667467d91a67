"""Sentiment within the row: own scores per row, one reading of the text, failing models, streams."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from broadsheet.operators import models
from broadsheet.plans import texts
from broadsheet.schemas import SENTIMENT_LABELS as LABELS
from broadsheet.sources import tables as TB
from broadsheet.streaming import jobs


def score(label):
    return F.col("sentiment_analysis.overall_sentiment.scores")[label].alias(label)


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return models.train_sentiment(TB.labelled(spark, sf_dir, how="inner"), features=1 << 10, max_iter=5)


def frame(spark, contents):
    return spark.createDataFrame([("u", x) for x in contents], "url string, content string")


def test_row_scores_equal_the_pipeline(spark, sf_dir, model):
    short = TB.articles(spark, sf_dir).where("length(content) <= 2048").select("url", "content")
    codes = short.withColumn("codes", models.word_codes(F.col("content")))
    theirs = {r.url: r.p for r in model.transform(codes).select("url", vector_to_array("probability").alias("p")).collect()}
    ours = models.analyse_sentiment(short, model, TB.AS_OF).select("url", *map(score, LABELS)).collect()
    assert len(ours) == len(theirs) > 0
    for r in ours:
        found = [r[x] for x in LABELS]
        assert found[: len(theirs[r.url])] == pytest.approx(list(theirs[r.url]), abs=1e-9)


def test_rows_with_one_url_keep_their_own_scores(spark):
    got = models.analyse_sentiment_with(frame(spark, ["abc", "abcd", "abcde"]), texts.length_rule, TB.AS_OF)
    labels = {r.content: r.label for r in got.select("content", texts.S.label_of().alias("label")).collect()}
    assert labels == {"abc": "negative", "abcd": "neutral", "abcde": "positive"}


def test_one_scan_and_no_shuffle(spark, sf_dir, model):
    rows = TB.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("url"), F.col("text").alias("content"))
    plan = models.analyse_sentiment(rows, model, TB.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("FileScan") == 1 and "Exchange" not in plan


@pytest.mark.parametrize(
    "answer", [lambda chunks: 1 / 0, lambda chunks: [], lambda chunks: [[0.0, float("nan"), 1.0]] * len(chunks)]
)
def test_a_failing_model_gives_neutral_and_the_reason(spark, answer):
    got = models.analyse_sentiment_with(frame(spark, ["some text", None, "  "]), lambda: answer, TB.AS_OF)
    rows = got.select("content", score("neutral"), F.col("sentiment_analysis.error").alias("error")).collect()
    assert [r.neutral for r in rows] == [1.0] * 3
    errors = {r.content: r.error for r in rows}
    assert errors[None] == errors["  "] == "missing content" and "Error: " in errors["some text"]


def test_texts_without_words_and_empty_tables(spark, model):
    odd = frame(spark, ["123 !!", "", None, "a " * 3000])
    rows = models.analyse_sentiment(odd, model, TB.AS_OF).select(score("neutral")).collect()
    assert len(rows) == 4 and all(0 <= r.neutral <= 1 for r in rows)
    words = models.sentiment_words(odd, model).collect()
    assert len(words) == 4 and all(r.negative == r.neutral == r.positive == [] for r in words)
    assert models.analyse_sentiment(odd.limit(0), model, TB.AS_OF).count() == 0


def test_stream_equals_batch(spark, sf_dir, model, tmp_path):
    path = str(tmp_path / "in")
    TB.table(spark, sf_dir, "documents").repartition(3, "doc_id").write.parquet(path)
    stream = TB.with_stage_times(TB.as_articles(jobs.read_folder_stream(spark, path)))
    jobs.to_files(models.analyse_sentiment(stream, model, TB.AS_OF), str(tmp_path / "out"), str(tmp_path / "cp"))
    columns = ["url", *map(score, LABELS)]
    batch = models.analyse_sentiment(TB.articles(spark, sf_dir), model, TB.AS_OF).select(columns)
    streamed = spark.read.parquet(str(tmp_path / "out")).select(columns)
    assert streamed.count() == 200 and streamed.exceptAll(batch).count() == 0
