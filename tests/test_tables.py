"""Stage tables, changes in place, views, ledger and index: repeats, crashes and pruning."""

import os
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import sentiment as S
from broadsheet.functions import text as X
from broadsheet.operators import index, ledger, search, sink, store, trends, views
from broadsheet.plans import sinks
from broadsheet.plans import sqlparts as Q
from broadsheet.schemas import STAGE_TABLES
from broadsheet.sources import tables as TB
from broadsheet.sources.keyed import KeyedTable
from broadsheet.streaming import jobs, progress

NOW = TB.AS_OF


def rows_of(df):
    return Counter(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def messages(spark, sf_dir):
    return TB.as_sink_messages(TB.labelled(spark, sf_dir)).cache()


@pytest.fixture(scope="module")
def folded(spark, messages, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sink"))
    sink.log_batch(messages, 0, path, NOW)
    sink.fold(spark, path)
    return {t: rows_of(sink.table_of(spark, path, t).read()) for t in STAGE_TABLES.values()}


def tables(spark, path):
    return {t: rows_of(sink.table_of(spark, path, t).read()) for t in STAGE_TABLES.values()}


# --- sink --------------------------------------------------------------------


def test_batches_in_any_cut_give_the_same_tables(spark, messages, folded, tmp_path):
    path = str(tmp_path)
    low, high = messages.where("offset % 2 = 1"), messages.where("offset % 2 = 0")
    sink.log_batch(low, 0, path, NOW)
    sink.fold(spark, path)
    sink.log_batch(high, 1, path, NOW)
    before = {t: rows_of(sink.current(spark, path, t)) for t in STAGE_TABLES.values()}
    sink.fold(spark, path)
    assert before == tables(spark, path) == folded
    assert sum(map(sum, (c.values() for c in folded.values()))) > 100


def test_a_replayed_batch_changes_nothing(spark, messages, folded, tmp_path):
    path = str(tmp_path)
    sink.log_batch(messages, 0, path, NOW)
    sink.log_batch(messages, 0, path, NOW)  # repeated before the fold
    sink.fold(spark, path)
    marks = [sink.table_of(spark, path, t).mark() for t in STAGE_TABLES.values()]
    older = messages.withColumn("value", F.replace("value", F.lit("-late"), F.lit("-old")))
    sink.log_batch(older, 0, path, NOW)  # repeated after it: the mark covers the batch
    assert set(sink.fold(spark, path).values()) == {0}
    assert marks == [0] * 4 and tables(spark, path) == folded
    assert sink.rejected(spark, path).count() > 0


def test_a_fold_that_dies_changes_nothing(spark, messages, folded, tmp_path, monkeypatch):
    path = str(tmp_path)
    sink.log_batch(messages.where("offset % 2 = 1"), 0, path, NOW)
    sink.fold(spark, path)
    sink.log_batch(messages, 1, path, NOW)
    first = tables(spark, path)

    def dies(*args, **kwargs):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:  # files written, no commit
        m.setattr(KeyedTable, "_commit", dies)
        with pytest.raises(RuntimeError):
            sink.fold(spark, path)
    assert tables(spark, path) == first
    with monkeypatch.context() as m:  # committed, log not cleared
        m.setattr(sink, "clear_log", dies)
        with pytest.raises(RuntimeError):
            sink.fold(spark, path)
    assert tables(spark, path) == folded
    assert set(sink.fold(spark, path).values()) == {0}
    assert tables(spark, path) == folded
    table = sink.table_of(spark, path, "processed_articles")
    assert table.clean() > 0 and rows_of(table.read()) == folded["processed_articles"]
    assert not os.path.exists(f"{path}/log/batch_id=1/table_name=processed_articles")


def test_sink_stream_over_many_batches(spark, sf_dir, folded, tmp_path):
    source = str(tmp_path / "in")
    TB.table(spark, sf_dir, "documents").repartition(4, "doc_id").write.parquet(source)
    stream = TB.with_stage_times(TB.as_articles(jobs.read_folder_stream(spark, source)))
    sent = TB.as_sink_messages(TB.with_labels(stream, TB.table(spark, sf_dir, "labels")))
    for _ in range(2):  # the second run finds nothing new
        jobs.sink_job(sent, str(tmp_path / "s"), str(tmp_path / "cp"), NOW, fold_every=2)
    assert tables(spark, str(tmp_path / "s")) == folded


def test_sink_takes_odd_messages(spark, tmp_path):
    good = '{"title":"t","content":"c","url":"http://x","press":"p","category":"it","published_at":"2024-01-01T00:00:00"}'
    values = [
        ("news.it.processed", good), ("news.it.processed", None), ("news.it.summary", good), ("news.it.other", good),
        ("news..processed", good), ("news.it.sentiment", good.replace('"p"', '"q", "sentiment_analysis": {"sentiment": "negative"}')),
        ("news.it.processed", good.replace('"category":"it",', "")), ("news.it.raw", good.replace("2024", "x2024")),
    ]
    df = spark.createDataFrame([(t, v, i) for i, (t, v) in enumerate(values)], "topic string, value string, offset long")
    got = {r.offset: (r.table_name, r.reject_reason, r.category) for r in sink.records(df, NOW).collect()}
    assert got == {
        0: ("processed_articles", None, "it"), 1: ("rejected", "malformed json", None), 2: ("rejected", "missing summary", None),
        5: ("sentiment_articles", None, "it"), 6: ("processed_articles", None, "it"), 7: ("rejected", "bad published_at", None),
    }
    label = sink.records(df, NOW).where("offset = 5").select("sentiment_analysis.overall_sentiment.sentiment").first()[0]
    assert label == "negative"
    with pytest.raises(ValueError):
        sink.current(spark, str(tmp_path / "none"), "processed_articles")


# --- changes in place ----------------------------------------------------------


@pytest.fixture
def table(spark, sf_dir, tmp_path):
    rows = TB.labelled(spark, sf_dir).select("url", "press", "category", "published_at", "sentiment")
    odd = F.when(F.col("category") == "it", "it & a+b %20").otherwise(F.col("category"))
    return KeyedTable(spark, str(tmp_path / "t"), partition_by=["category"]).create(rows.withColumn("category", odd))


def files(table):
    return {r.file for r in table.live().collect()}


def test_only_touched_files_are_rewritten(table, spark):
    before, rows = files(table), rows_of(table.read())
    url = "https://example.org/a/7"
    assert table.update_one(F.col("url") == url, {"press": F.lit("new")}) == 1
    assert len(before - files(table)) == 1 and len(files(table) - before) == 1
    assert table.read().where("press = 'new'").select("url").collect()[0].url == url
    assert table.update(F.col("url") == url, {"press": F.lit("new")}) == 0
    changed = table.read().where(F.col("url") == url).first().category
    assert sum((rows_of(table.read()) - rows).values()) == 1 and changed


def test_odd_folder_names_and_moves_between_folders(table):
    odd = table.read().where("category = 'it & a+b %20'").count()
    assert odd > 0
    assert table.update(F.col("category") == "it & a+b %20", {"category": F.lit("x/y")}) == odd
    assert table.read().where("category = 'x/y'").count() == odd
    assert table.delete(F.col("category") == "x/y") == odd and table.delete(F.col("category") == "x/y") == 0
    assert table.delete(F.lit(None).cast("boolean")) == 0


def test_single_row_forms_and_refusals(table, spark):
    n = table.read().count()
    first = table.read().agg(F.min("url")).first()[0]
    assert table.delete_one(F.lit(True)) == 1 and table.read().where(F.col("url") == first).isEmpty()
    assert table.delete_one(F.col("press") == "none such") == 0
    row = {"url": "http://new", "press": "p", "category": "it"}
    assert table.update_one(F.col("url") == "http://new", {"press": F.lit("p")}, new_row=row) == 0
    assert table.update_one(F.col("url") == "http://new", {"press": F.lit("q")}, new_row=row) == 1
    assert table.read().count() == n
    with pytest.raises(ValueError, match="many"):
        table.update(F.lit(True), {"press": F.lit("p")}, upsert=True)
    with pytest.raises(ValueError, match="already"):
        table.insert(table.read().limit(1))
    with pytest.raises(ValueError, match="unique"):
        KeyedTable(spark, table.path + "2").create(table.read().unionByName(table.read()))


def test_a_table_may_become_empty(table, spark):
    rows = table.read().withColumn("o", F.lit(1)).cache()
    n = rows.count()
    assert table.delete(F.lit(True)) == n and table.read().count() == 0
    assert table.upsert(rows, "o") == n and table.read().count() == n
    assert table.upsert(rows.limit(0), "o") == 0


def test_expired_days_are_dropped_unread(spark, sf_dir, tmp_path):
    rows = TB.articles(spark, sf_dir).select("url", "published_at", F.to_date("published_at").alias("day"))
    table = KeyedTable(spark, str(tmp_path / "t"), partition_by=["day"]).create(rows)
    before = files(table)
    gone = table.expire("day", "2024-01-20 12:00:00")
    assert gone == rows.where("day < DATE'2024-01-20'").count() > 0
    assert files(table) < before and table.read().count() == rows.count() - gone
    assert table.expire("day", datetime(2024, 1, 20)) == 0
    with pytest.raises(ValueError):
        table.expire("published_at", "2024-01-20")


def test_lookup_opens_few_files_and_row_groups(spark, sf_dir, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wide = TB.articles(spark, sf_dir).select("url", "content", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("n"))
        keyed = wide.select(F.concat_ws("-", "url", "n").alias("url"), F.repeat("content", 2).alias("content"))
        table = KeyedTable(spark, str(tmp_path / "t"))
        spark.conf.set("parquet.block.size", str(1 << 20))
        table.create(keyed)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("parquet.block.size")
    assert table.live().count() > 2
    found = table.lookup("https://example.org/a/42-3").select("url")
    assert found.count() == 1 and len(found.inputFiles()) == 1
    plan = found._jdf.queryExecution().executedPlan()
    found._jdf.queryExecution().toRdd().count()
    read = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    assert read < table.live().agg(F.min("n_rows")).first()[0]
    assert table.lookup("https://example.org/a/none").count() == 0


# --- views -------------------------------------------------------------------


@pytest.fixture(scope="module")
def batches(spark, sf_dir):
    articles = TB.with_keywords(TB.labelled(spark, sf_dir), Q.STOPWORDS).cache()
    return [b.cache() for b in sinks.corrected_batches(articles)]


def recount(batches):
    """The newest version of every article, counted from scratch."""
    every = batches[0]
    for b in batches[1:]:
        every = every.unionByName(b)
    return store.latest_per_key(every, "url", "ingest_seq")


def view_rows(df):
    return rows_of(df.groupBy([c for c in df.columns if c != "n"]).agg(F.sum("n").alias("n")))


def expected(rows):
    return {
        name: view_rows(facts(rows).withColumn("n", F.lit(1).cast("long"))) for name, facts in views.VIEWS.items()
    }


def test_views_follow_corrections(spark, batches, tmp_path):
    path, table = str(tmp_path), KeyedTable(spark, f"{tmp_path}/table")
    for i, batch in enumerate(batches):
        views.apply_batch(table, batch, "ingest_seq", i, path)
        assert {n: view_rows(views.counts(spark, path, n)) for n in views.VIEWS} == expected(recount(batches[: i + 1]))
    views.compact(spark, path, table)
    views.compact(spark, path, table)
    assert {n: view_rows(views.counts(spark, path, n)) for n in views.VIEWS} == expected(recount(batches))
    final = recount(batches)
    for days in (3, 10, 30):
        half_open = final.where(F.col("published_at") < F.lit(NOW).cast("timestamp_ntz"))
        got = views.timeline(views.counts(spark, path, "articles"), NOW, "week", days, sentiment="neutral")
        assert rows_of(got) == rows_of(trends.timeline(half_open, NOW, "week", days, sentiment="neutral"))


def test_views_survive_repeats_and_crashes(spark, batches, tmp_path, monkeypatch):
    path, table = str(tmp_path), KeyedTable(spark, f"{tmp_path}/table")
    views.apply_batch(table, batches[0], "ingest_seq", 0, path)
    views.apply_batch(table, batches[0], "ingest_seq", 0, path)

    def dies(*args, **kwargs):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", dies)
        with pytest.raises(RuntimeError):
            views.apply_batch(table, batches[1], "ingest_seq", 1, path)
    seen = {n: view_rows(views.counts(spark, path, n, table.mark())) for n in views.VIEWS}
    assert seen == expected(recount(batches[:1]))
    views.compact(spark, path, table)  # takes in committed batches only
    views.apply_batch(table, batches[1], "ingest_seq", 1, path)
    assert {n: view_rows(views.counts(spark, path, n)) for n in views.VIEWS} == expected(recount(batches[:2]))


# --- ledger ------------------------------------------------------------------


def test_ledger_stores_every_message_once(spark, tmp_path):
    path = str(tmp_path)
    rows = [("news.it.raw" if i % 5 else "news.it & a+b.raw", f"v{i}", i % 2, i) for i in range(100)]
    df = spark.createDataFrame(rows, "topic string, value string, partition int, offset long")
    # An unfinished run leaves a folder that the ledger does not name.
    df.withColumn("category", F.lit("it")).write.partitionBy("category").json(f"{path}/data/attempt=dead")
    assert ledger.archive(df.where("offset BETWEEN 20 AND 39"), path) == 20
    assert ledger.archive(df.where("offset BETWEEN 30 AND 59"), path) == 20
    assert ledger.archive(df.where("offset >= 80"), path) == 20
    assert ledger.archive(df.limit(0), path) == 0
    assert ledger.archive(df, path) == 40 and ledger.archive(df, path) == 0
    stored = ledger.stored(spark, path)
    assert rows_of(stored.select(*df.columns)) == rows_of(df)
    assert {r.category for r in stored.select("category").distinct().collect()} == {"it", "it & a+b"}
    # Offsets are shared among four topic partitions here, so ranges that only touch stay apart.
    assert ledger.covered(spark, path).count() == 8


def test_ledger_of_nothing(spark, tmp_path):
    assert ledger.stored(spark, str(tmp_path)).count() == 0


def test_a_stream_started_anew_archives_nothing_twice(spark, tmp_path):
    rows = [("news.it.raw", f"v{i}", 0, i) for i in range(30)]
    df = spark.createDataFrame(rows, "topic string, value string, partition int, offset long")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    for checkpoint in ("a", "a", "b"):
        jobs.ledger_job(jobs.read_folder_stream(spark, str(tmp_path / "in"), 10), str(tmp_path / "out"), str(tmp_path / checkpoint))
    assert rows_of(ledger.stored(spark, str(tmp_path / "out")).select(*df.columns)) == rows_of(df)


def test_ranges_that_touch_become_one(spark, tmp_path):
    df = spark.range(40).selectExpr("'news.it.raw' AS topic", "'v' AS value", "0 AS partition", "id AS offset")
    for low, high in ((0, 9), (10, 19), (5, 25), (30, 39)):
        ledger.archive(df.where(F.col("offset").between(low, high)), str(tmp_path))
    assert [tuple(r)[2:] for r in ledger.covered(spark, str(tmp_path)).orderBy("first").collect()] == [(0, 25), (30, 39)]


# --- index -------------------------------------------------------------------


@pytest.fixture(scope="module")
def articles(spark, sf_dir):
    return TB.with_keywords(TB.labelled(spark, sf_dir), Q.STOPWORDS).cache()


@pytest.fixture(scope="module")
def indexed(articles, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    index.build(articles, path, buckets=16)
    return path


@pytest.mark.parametrize(
    "request_",
    [
        dict(query="th on"), dict(query="  THand pour "), dict(query="zzzz"), dict(query="th.|pour", literal=False), dict(),
        dict(include_keywords=["IS"]), dict(include_keywords=["is", "on"], exclude_keywords=["des"]), dict(exclude_keywords=["is"]),
        dict(query="e", categories=["it"], press=["src2"], sentiments=["positive"], start_date="2024-01-02", end_date="2024-01-20"),
        dict(query="a", page=3, size=7), dict(query="%"), dict(query="."),
    ],
)
def test_index_finds_what_a_search_of_the_texts_finds(spark, articles, indexed, request_):
    request = search.SearchRequest(**request_)
    columns = ["url", "title", "press", "category", "published_at", "total"]
    theirs = [tuple(r) for r in search.search(articles, request).select(*columns).collect()]
    ours = [tuple(r) for r in index.find(spark, indexed, request, buckets=16).select(*columns).collect()]
    assert ours == theirs


def test_keyword_search_reads_its_buckets_only(spark, indexed):
    found = index.urls_of(spark, indexed, index.KEYWORD, ["is"], buckets=16)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket#" in plan.split("PartitionFilters")[1].split("]")[0]
    folders = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}
    metrics = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    found._jdf.queryExecution().toRdd().count()
    assert metrics.metrics().apply("numPartitions").value() == 1 < len(folders)
    assert "content" not in plan


def test_index_of_nothing(spark, articles, tmp_path):
    index.build(articles.limit(0), str(tmp_path), buckets=4)
    assert index.find(spark, str(tmp_path), search.SearchRequest(query="a"), buckets=4).count() == 0


# --- a batch is computed once ---------------------------------------------------


def test_a_batch_is_computed_once_for_table_and_views(spark, tmp_path):
    rows = [(f"u{i}", "it", datetime(2024, 1, 1, i), ["a", "b"], 1) for i in range(8)]
    batch = spark.createDataFrame(rows, "url string, category string, published_at timestamp_ntz, keywords array<string>, ingest_seq int")
    batch = batch.withColumns({"processed_at": F.col("published_at"), "sentiment_analysis": S.analysis(S.one_hot(F.lit("neutral")))})
    calls = spark.sparkContext.accumulator(0)

    def counted(words):
        calls.add(1)
        return words

    batch = X.compute_once(batch, "keywords", F.udf(counted, "array<string>")(F.col("keywords")))
    table = KeyedTable(spark, str(tmp_path / "table"))
    for number in range(2):
        views.apply_batch(table, batch, "ingest_seq", number, str(tmp_path))
    assert calls.value == 2 * len(rows)
    assert not any((tmp_path / "incoming").iterdir())
    assert table.read().count() == len(rows)
    assert {r.keyword: r.n for r in views.counts(spark, str(tmp_path), "keywords").groupBy("keyword").agg(F.sum("n").alias("n")).collect()} == {"a": 8, "b": 8}


# --- state per article -----------------------------------------------------------


def run_progress(spark, folder, rows=None, ways=0):
    schema = "url string, stage string, at timestamp"
    if rows:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    told = progress.stage_progress(stream, timedelta(hours=6), timedelta(days=3), ways=ways)
    jobs.to_files(told, f"{folder}/out", f"{folder}/cp")
    done = spark.read.schema(progress.EVENTS).parquet(f"{folder}/out")
    return Counter((r.url, r.event, r.stages) for r in done.collect())


@pytest.mark.parametrize("ways", [0, 4])
def test_stages_and_lateness_are_told_once_over_restarts(spark, tmp_path, ways):
    t, folder = datetime(2024, 1, 1), str(tmp_path)
    hour = timedelta(hours=1)
    whole = [("a", s, t + i * hour) for i, s in enumerate(("raw", "processed", "sentiment", "summary"))]
    first = whole + [("b", "raw", t)] * 50 + [("c", "raw", t + 30 * hour), ("c", "odd", t + 30 * hour)]
    told = run_progress(spark, folder, first, ways)
    want = Counter([("a", "stage", s) for _, s, _ in whole])
    want += Counter([("b", "stage", "raw"), ("b", "late", "processed sentiment summary"), ("c", "stage", "raw")])
    assert told == want
    assert run_progress(spark, folder, ways=ways) == want  # a restart finds nothing new
    told = run_progress(spark, folder, [("b", "processed", t + 32 * hour), ("b", "raw", t + 33 * hour), ("d", "raw", t + 50 * hour)], ways)
    want += Counter([("b", "late stage", "processed"), ("c", "late", "processed sentiment summary"), ("d", "stage", "raw")])
    assert told == want


def test_progress_runs_where_the_session_keeps_state_in_memory(spark, tmp_path):
    t, name = datetime(2024, 1, 1), "spark.sql.streaming.stateStore.providerClass"
    memory = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    rows = [("a", s, t) for s in ("raw", "processed", "sentiment", "summary")] + [("b", "raw", t), ("c", "raw", t + timedelta(days=1))]
    schema = "url string, stage string, at timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    given = spark.conf.get(name)
    spark.conf.set(name, memory)
    try:
        progress.progress_job(stream, timedelta(hours=6), timedelta(days=3), str(tmp_path / "out"), str(tmp_path / "cp"))
        assert spark.conf.get(name) == memory
    finally:
        spark.conf.set(name, given)
    done = spark.read.schema(progress.EVENTS).parquet(str(tmp_path / "out"))
    assert Counter((r.url, r.event) for r in done.collect()) == {("a", "stage"): 4, ("b", "stage"): 1, ("b", "late"): 1, ("c", "stage"): 1}


# --- trending ----------------------------------------------------------------


def test_trending_follows_late_corrections(spark, tmp_path):
    t = datetime(2024, 1, 10)
    day = timedelta(days=1)
    parts = [
        [(t, "x", 1), (t, "x", 1), (t, "y", 1)],
        [(t + day, "y", 1), (t, "x", -1)],  # a correction of an earlier day
        [(t + 2 * day, "z", 1), (t, "x", -1), (t, "y", 1)],
    ]
    schema = "at timestamp, keyword string, n int"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        jobs.keep_latest(jobs.live_trending(stream, "5 days", "7 days", "1 day"), str(tmp_path / "out"), str(tmp_path / "cp"))
    counts = jobs.latest_counts(spark, str(tmp_path / "out"), ["window_end", "keyword"], ["count"])
    got = {(r.window_end, r.keyword): r["count"] for r in jobs.top_keywords(counts).collect()}
    want = Counter()
    for at, word, n in [x for p in parts for x in p]:
        for d in range(1, 8):
            want[at + d * day, word] += n
    assert got == {k: n for k, n in want.items() if n > 0}
