from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.operators import store
from broadsheet.session import shared_dir

STORED = "url string, title string, press string"
INCOMING = "url string, title string, ingest_seq int"


def by_url(df):
    return {r.url: (r.title, r.press) for r in df.collect()}


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_merge_overwrites_carried_columns_only(spark, threshold):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        stored = spark.createDataFrame([("a", "A", "p"), ("b", "B", "q")], STORED)
        new = spark.sql("SELECT * FROM VALUES ('a', 'x', 1), ('a', NULL, 2), ('c', 'C', 1) AS t(url, title, ingest_seq)")
        merged = store.upsert_merge(stored, new)
        assert by_url(merged) == {"a": (None, "p"), "b": ("B", "q"), "c": ("C", None)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from(["x", "y", None])), max_size=8))
def test_merge_equals_writing_one_by_one(spark, writes):
    table = {"a": ("A", "p"), "b": ("B", "q")}
    stored = spark.createDataFrame([(k, *v) for k, v in table.items()], STORED)
    new = spark.createDataFrame([(u, t, i) for i, (u, t) in enumerate(writes)], INCOMING)
    for url, title in writes:
        table[url] = (title, table.get(url, (None, None))[1])
    assert by_url(store.upsert_merge(stored, new)) == table


def test_a_hot_key_is_thinned_before_the_shuffle(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url"),
        F.col("id").alias("ingest_seq"),
    )
    latest = store.latest_per_key(rows)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert latest.count() == 20_001
    assert latest.where("url = 'hot'").first().ingest_seq == 29_997


def test_newest_per_group_pages(spark):
    rows = [("c", f"u{i}", datetime(2024, 1, 1 + i)) for i in range(5)] + [("d", "v", None)]
    df = spark.createDataFrame(rows, "category string, url string, published_at timestamp_ntz")
    got = store.newest_per_group(df, "category", limit=2, skip=1).collect()
    assert sorted((r.category, r.url, r["rank"]) for r in got) == [("c", "u2", 3), ("c", "u3", 2)]


def test_find_many_orders_missing_values_and_pages(spark):
    df = spark.createDataFrame([("a", None), ("b", 2), ("c", 1), ("d", 2)], "url string, n int")
    assert [r.url for r in store.find_many(df, sort=[("n", 1)]).collect()] == ["a", "c", "b", "d"]
    assert [r.url for r in store.find_many(df, sort=[("n", -1)]).collect()] == ["b", "d", "c", "a"]
    page = store.find_many(df, F.col("n") > 0, ["url"], [("n", -1)], skip=1, limit=1)
    assert [tuple(r) for r in page.collect()] == [("d",)]
    assert store.find_many(df).count() == 4
    assert store.find_one(df, F.col("n") == 2).first().url == "b"


def test_update_and_delete_with_unknown_conditions(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 2)], "url string, n int")
    changed = store.update_where(df, F.col("n") >= 1, {"n": F.lit(2)})
    assert {r.url: (r.n, r.changed) for r in changed.collect()} == {"a": (2, True), "b": (None, False), "c": (2, False)}
    assert sorted(r.url for r in store.delete_where(df, F.col("n") == 1).collect()) == ["b", "c"]


def test_retention_keeps_stages_without_a_limit(spark):
    at = datetime(2024, 1, 20)
    df = spark.createDataFrame([("raw", at), ("processed", at), ("other", at)], "stage string, at timestamp_ntz")
    kept = store.within_retention(df, F.col("stage"), F.col("at"), "2024-01-31 00:00:00")
    assert sorted(r.stage for r in kept.collect()) == ["other", "processed"]


def test_unprocessed_are_oldest_first(spark):
    raw = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2), ("d", None)], "url string, collected_at int")
    done = spark.createDataFrame([("b",), ("b",)], "url string")
    assert [r.url for r in store.unprocessed(raw, done, 2).collect()] == ["d", "c"]


def test_stage_coverage_flags(spark):
    one = spark.createDataFrame([("a",), ("b",)], "url string")
    two = spark.createDataFrame([("b",), ("b",), ("c",)], "url string")
    rows = {r.url: (r.raw, r.summary) for r in store.stage_coverage({"raw": one, "summary": two}).collect()}
    assert rows == {"a": (True, False), "b": (True, True), "c": (False, True)}


def test_stamp_and_key_violations(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "url string")
    assert {r.processed_at for r in store.stamp(df, "processed", "2024-01-31").collect()} == {datetime(2024, 1, 31)}
    assert [tuple(r) for r in store.key_violations(df).collect()] == [("a", 2)]


def test_shared_folder_is_the_sessions_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
