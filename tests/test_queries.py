"""Every registered query: same rows as its SQL, and a plan without pair-wise joins."""

import pytest

import compare
from broadsheet import plans

QUERIES = plans.queries()
ORACLES = plans.oracle_sql()
STREAMS = [n for n in QUERIES if n.startswith("stream_")]
MODELS = {"sentiment_stage", "sentiment_keywords", "topics_lda", "topics_anchored"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark, con, sf_dir):
    assert compare.differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


#: These write tables first and return a plain read; running them again would show no more of their plans.
WRITERS = {n for n, f in QUERIES.items() if f.__module__.endswith(".sinks")} - {"search_indexed", "index_terms"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STREAMS) - MODELS - WRITERS))
def test_plan_has_no_cross_join(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_only_model_queries_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == MODELS


def test_sentiment_stage_invariants(spark, sf_dir):
    rows = QUERIES["sentiment_stage"](spark, sf_dir).collect()
    assert len(rows) == 200
    for r in rows:
        scores = {x: r[x] for x in ("negative", "neutral", "positive")}
        assert abs(sum(scores.values()) - 1) < 1e-6
        assert scores[r.sentiment] == max(scores.values())


def test_sentiment_keywords_are_top_words_once(spark, sf_dir):
    for r in QUERIES["sentiment_keywords"](spark, sf_dir).collect():
        words = [w for x in ("negative", "neutral", "positive") for w in r[x].split()]
        assert len(words) == len(set(words)) <= 30


def test_topics_lda_covers_every_article(spark, sf_dir):
    rows = QUERIES["topics_lda"](spark, sf_dir).collect()
    assert len(rows) == 200
    assert all(0.2 <= r.best_share <= 1.0 for r in rows)
    assert all(r.main_topics and r.best_words for r in rows if r.best_share > 0.2)
