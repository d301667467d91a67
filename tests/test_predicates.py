from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
import pytest

from broadsheet.functions import predicates as PR
from broadsheet.functions import sentiment as S
from broadsheet.functions import times as TM
from broadsheet.functions import topics as TP
from broadsheet.operators.search import SearchRequest, condition_of


@pytest.fixture(scope="module")
def keyworded(spark):
    rows = [(1, ["a", "b"]), (2, ["b"]), (3, None), (4, [])]
    return spark.createDataFrame(rows, "id int, keywords array<string>").cache()


def ids(df):
    return sorted(r.id for r in df.collect())


def test_array_predicates_and_missing_arrays(keyworded):
    k = F.col("keywords")
    assert ids(keyworded.where(PR.has_any(k, ["a"]))) == [1]
    assert ids(keyworded.where(PR.has_all(k, ["A", "b"]))) == [1]
    assert ids(keyworded.where(PR.has_none(k, ["A"]))) == [2, 3, 4]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.lists(st.sampled_from("abc"), max_size=3)), min_size=1, max_size=6),
    st.lists(st.sampled_from("abc"), min_size=1, max_size=2),
)
def test_array_predicates_against_sets(spark, arrays, wanted):
    df = spark.createDataFrame(list(enumerate(arrays)), "id int, k array<string>")
    k = F.col("k")
    for predicate, plain in (
        (PR.has_any, lambda a: a is not None and bool(set(a) & set(wanted))),
        (PR.has_all, lambda a: a is not None and set(wanted) <= set(a)),
        (PR.has_none, lambda a: a is None or not set(a) & set(wanted)),
    ):
        assert ids(df.where(predicate(k, wanted))) == [i for i, a in enumerate(arrays) if plain(a)]


def test_title_terms_are_literal_unless_asked(spark):
    df = spark.createDataFrame([(1, "Price (USD) up"), (2, "nothing"), (3, None)], "id int, title string")
    assert ids(df.where(PR.title_matches(F.col("title"), "  (usd) "))) == [1]
    assert ids(df.where(PR.title_matches(F.col("title"), "^pri.e", literal=False))) == [1]
    with pytest.raises(Exception):
        df.where(PR.title_matches(F.col("title"), "(usd", literal=False)).collect()


def test_search_without_clauses_matches_all_and_bounds_are_checked(spark):
    assert spark.range(3).where(condition_of(SearchRequest())).count() == 3
    for bad in ({"page": 0}, {"size": 0}, {"size": 101}):
        with pytest.raises(ValueError):
            SearchRequest(**bad)


def test_moment_takes_naive_as_utc_and_converts_others(spark):
    zoned = datetime(2024, 1, 1, 9, tzinfo=timezone(timedelta(hours=9)))
    row = spark.range(1).select(TM.moment(zoned).alias("a"), TM.moment(datetime(2024, 1, 1)).alias("b")).first()
    assert row.a == row.b == datetime(2024, 1, 1)


def test_buckets_and_iso_week_at_the_year_end(spark):
    df = spark.createDataFrame([("2024-12-30 23:05:00",), ("2027-01-01 00:00:00",)], "t string")
    at = F.col("t").cast("timestamp_ntz")
    rows = df.select(*[TM.bucket(at, i).alias(i) for i in ("hour", "day", "week", "month")]).collect()
    assert rows[0].asDict() == {"hour": "2024-12-30-23", "day": "2024-12-30", "week": "2025-01", "month": "2024-12-30"}
    assert rows[1].week == "2026-53"


def test_page_dates_fall_back_to_as_of(spark):
    df = spark.createDataFrame([(" 2024-01-02 03:04:05 ",), ("2024.01.02 03:04",), ("soon",), (None,)], "t string")
    got = [r[0] for r in df.select(TM.parse_page_date(F.col("t"), "2024-02-01 00:00:00")).collect()]
    assert got == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4)] + [datetime(2024, 2, 1)] * 2


def test_window_of_no_days_has_no_bound(spark):
    df = spark.createDataFrame([("1999-01-01",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert df.where(TM.since(F.col("t"), "2024-01-31", 0)).count() == 1
    assert df.where(TM.since(F.col("t"), "2024-01-31", 7)).count() == 0


def test_topic_lists_and_replay_choice():
    assert len(TP.topic_list("processed")) == 7
    assert TP.topic_list("processed", "economy") == TP.topic_list("processed")
    assert TP.topic_list("processed", ["sports"]) == []
    assert TP.replay_categories("it", "economy") == ["it"]
    assert TP.replay_categories(None, "economy", ["it"]) == ["economy"]
    assert TP.replay_categories(None, "sports", ["it", "sports"]) == ["it"]
    assert len(TP.replay_categories(None, None, ["sports"])) == 7
    with pytest.raises(ValueError):
        TP.replay_categories("sports")


def test_topic_columns(spark):
    topics = ["news.it.processed", "news.it.raw", "x", "other.it.summary", "news.a.b.processed"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(topics)], "i int, topic string")
    rows = df.orderBy("i").select(
        TP.target_table(F.col("topic")).alias("table"),
        TP.topic_part(F.col("topic"), 1).alias("part"),
        TP.category_between(F.col("topic"), "processed").alias("between"),
    ).collect()
    assert [r.table for r in rows] == ["processed_articles", None, None, None, None]
    assert [r.part for r in rows] == ["it", "it", "unknown", "it", "a"]
    assert [r.between for r in rows] == ["it", None, None, None, "a.b"]


def test_lookups_have_defaults(spark):
    df = spark.createDataFrame([("it",), ("sports",), (None,)], "c string")
    rows = df.select(TP.display_name(F.col("c")), TP.category_code(F.col("c"))).collect()
    assert [tuple(r) for r in rows] == [("IT", "IT"), (None, "100"), (None, "100")]


def test_argmax_takes_the_first_label_on_a_tie(spark):
    arrays = [[0.2, 0.4, 0.4], [0.5, 0.5, 0.0], [0.1, 0.2, 0.3, 0.4]]
    df = spark.createDataFrame([(a,) for a in arrays], "s array<double>")
    assert [r[0] for r in df.select(S.argmax_label(F.col("s"))).collect()] == ["neutral", "negative", "unknown"]
    soft = df.select(S.softmax(F.col("s")).alias("p")).collect()
    assert all(abs(sum(r.p) - 1) < 1e-9 for r in soft)
