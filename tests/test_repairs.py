"""Tables of many files, closed windows, repaired records and ties."""

import json

from pyspark.sql import functions as F

from broadsheet.functions import times as TM
from broadsheet.operators import enrich, store
from broadsheet.sources import messages as M
from broadsheet.streaming import jobs


def test_stream_reads_single_files_and_folders(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for folder, name in ((sf_dir, "one"), (str(tmp_path), "many")):
        stream = jobs.read_table_stream(spark, folder, "documents").select("doc_id")
        writer = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out-{name}")
        jobs.drain(writer, f"{tmp_path}/check-{name}")
        assert spark.read.parquet(f"{tmp_path}/out-{name}").distinct().count() == 200


def test_window_is_closed_at_both_ends(spark):
    days = [("2024-01-01",), ("2024-01-10",), ("2024-01-15",), ("2024-01-20",)]
    df = spark.createDataFrame(days, "d string").select(F.col("d").cast("timestamp_ntz").alias("t"))
    kept = df.where(TM.since(F.col("t"), "2024-01-15", 7)).count()
    assert kept == 2
    assert df.where(TM.since(F.col("t"), "2024-01-15", 0)).count() == 4


def test_records_without_category_or_collection_time_are_repaired(spark):
    record = {"title": "t", "content": "c", "url": "http://a.example", "press": "p", "published_at": "2024-01-01T00:00:00"}
    df = spark.createDataFrame(
        [("news.economy.raw", json.dumps(record), 1), ("news.economy.raw", json.dumps(record | {"url": "ftp://a"}), 2)],
        "topic string, value string, offset long",
    )
    rows = M.accepted(M.checked(df)).collect()
    assert [(r.offset, r.category, r.collected_at) for r in rows] == [(1, "economy", None)]
    assert [r.reject_reason for r in M.rejected(M.checked(df)).collect()] == ["bad url"]


def test_lost_offsets_fail_unless_asked_otherwise():
    assert M.kafka_options("h:1", topics=["a"])["failOnDataLoss"] == "true"
    assert M.kafka_options("h:1", topics=["a"], fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_equal_numbers_have_one_winner_in_any_order(spark):
    rows = [("a", f"title {i}", 7) for i in range(20)]
    winners = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "url string, title string, ingest_seq int").repartition(5)
        winners.add(store.latest_per_key(df).first().title)
    assert len(winners) == 1


def test_offsets_become_utc_in_any_session_zone(spark):
    texts = ["2024-01-01T10:00:00", "2024-01-01T10:00:00Z", "2024-01-01T10:00:00+09:00", "2024-01-01T10:00:00.5-0330", "soon", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = ["2024-01-01 10:00:00", "2024-01-01 10:00:00", "2024-01-01 01:00:00", "2024-01-01 13:30:00.5", None, None]
    for zone in ("UTC", "Asia/Seoul", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = [r[0] for r in df.orderBy("i").select(TM.parse_iso(F.col("t")).cast("string")).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == want


def test_empty_logs_are_empty_tables(spark, tmp_path):
    path = str(tmp_path / "none")
    assert jobs.latest_changes(spark, path, schema="url string, ingest_seq int").count() == 0
    assert jobs.latest_counts(spark, path, ["topic"], ["count"], schema="topic string, count long").count() == 0


def test_a_summary_that_reads_like_an_error_is_none(spark):
    text = enrich.BATCH_ERROR_PREFIX + "is how this article begins. " * 10
    df = spark.createDataFrame([(text,), ("x" * 200,)], "content string")

    def load():
        def model(texts):
            if any(t.startswith("x") for t in texts):
                raise RuntimeError("no")
            return texts

        return model

    rows = enrich.summarize_with(df, load, "m", "t", "2024-01-01", batch_size=1).select("summary_info.*").collect()
    assert [r.model_info.name == enrich.BATCH_ERROR_MODEL_NAME for r in rows] == [False, True]
    assert rows[0].sentence_count > 0 and rows[1].sentence_count == 0 and all(r.processing_time_seconds > 0 for r in rows)
