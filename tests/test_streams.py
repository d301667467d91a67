"""A stream over many files must end with the rows the batch query gives."""

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import topics as TP
from broadsheet.operators import store
from broadsheet.plans import sqlparts as Q
from broadsheet.plans import texts
from broadsheet.sources import messages as M
from broadsheet.sources import tables as TB
from broadsheet.streaming import jobs


@pytest.fixture(scope="module")
def parts(spark, sf_dir, tmp_path_factory):
    """The documents split into five files, read one file per micro-batch."""
    path = str(tmp_path_factory.mktemp("in") / "documents")
    TB.table(spark, sf_dir, "documents").repartition(5, "doc_id").write.parquet(path)
    return path


def labelled(spark, sf_dir, parts, how="left"):
    documents = jobs.read_folder_stream(spark, parts, files_per_trigger=1)
    return TB.with_labels(TB.with_stage_times(TB.as_articles(documents)), TB.table(spark, sf_dir, "labels"), how)


def test_text_job_equals_batch_and_resumes(spark, sf_dir, parts, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for _ in range(2):  # the second run finds nothing new
        jobs.text_job(TB.as_messages(labelled(spark, sf_dir, parts)), TB.AS_OF, out, checkpoint, Q.STOPWORDS)
    done = spark.read.parquet(out)
    assert done.count() == 200
    batch = texts.text_stage(spark, sf_dir).select("url", "keywords")
    ours = done.where("outcome = 'processed'").select("url", F.array_join("keywords", " ").alias("keywords"))
    assert ours.exceptAll(batch).count() == 0
    rejected = M.rejected(M.checked(TB.messages(spark, sf_dir))).select("offset", "reject_reason")
    theirs = done.where("outcome = 'rejected'").select("offset", "reject_reason")
    assert theirs.exceptAll(rejected).count() == rejected.exceptAll(theirs).count() == 0


def test_upsert_log_folds_into_the_table(spark, sf_dir, parts, tmp_path):
    log = str(tmp_path / "log")
    jobs.upsert_job(TB.as_changes(labelled(spark, sf_dir, parts, "inner")), log, str(tmp_path / "cp"))
    existing = TB.existing_table(spark, sf_dir)
    streamed = store.upsert_merge(existing, jobs.latest_changes(spark, log))
    batch = store.upsert_merge(existing, TB.as_changes(TB.labelled(spark, sf_dir, "inner")))
    assert streamed.exceptAll(batch).count() == batch.exceptAll(streamed).count() == 0


def test_a_repeated_batch_replaces_its_folder(spark, tmp_path):
    write = jobs.batch_folders(str(tmp_path / "log"))
    df = spark.createDataFrame([("a", 1)], "url string, ingest_seq int")
    write(df, 0)
    write(df, 0)
    write(df.withColumn("ingest_seq", F.lit(0)), 1)
    rows = jobs.latest_changes(spark, str(tmp_path / "log")).collect()
    assert [tuple(r[c] for c in ("url", "ingest_seq")) for r in rows] == [("a", 0)]


def test_counters_and_timeline_over_batches(spark, sf_dir, parts, tmp_path):
    counts = jobs.topic_counters(TB.as_messages(labelled(spark, sf_dir, parts)))
    jobs.keep_latest(counts, str(tmp_path / "c"), str(tmp_path / "ccp"))
    last = jobs.latest_counts(spark, str(tmp_path / "c"), ["topic"], ["count"])
    batch = TB.messages(spark, sf_dir).groupBy("topic").count()
    assert last.exceptAll(batch).count() == batch.exceptAll(last).count() == 0

    jobs.keep_latest(jobs.live_timeline(labelled(spark, sf_dir, parts), "60 days"), str(tmp_path / "t"), str(tmp_path / "tcp"))
    total = jobs.latest_counts(spark, str(tmp_path / "t"), ["bucket_start"], ["count"]).agg(F.sum("count")).first()[0]
    assert total == 200


def test_dedup_keeps_one_of_many_copies(spark, sf_dir, parts, tmp_path):
    sent = labelled(spark, sf_dir, parts).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40))))
    hot = sent.withColumn("url", F.when(F.col("lang") == "en", "hot").otherwise(F.col("url")))
    jobs.to_files(jobs.dedup(hot, "url", "published_at", "60 days", F.col("n")).select("url"), str(tmp_path / "o"), str(tmp_path / "cp"))
    urls = [r.url for r in spark.read.parquet(str(tmp_path / "o")).collect()]
    assert len(urls) == len(set(urls))
    other = TB.articles(spark, sf_dir).where("lang <> 'en'").count()
    assert len(urls) == other + 1


def test_archive_keeps_every_raw_message(spark, sf_dir, parts, tmp_path):
    raw = M.by_pattern(TB.as_messages(labelled(spark, sf_dir, parts)), TP.RAW_PATTERN)
    jobs.archive_job(raw, str(tmp_path / "o"), str(tmp_path / "cp"))
    stored = spark.read.json(str(tmp_path / "o")).select("value")
    sent = M.by_pattern(TB.messages(spark, sf_dir), TP.RAW_PATTERN).select("value")
    assert stored.exceptAll(sent).count() == sent.exceptAll(stored).count() == 0


def test_stop_when_idle(spark, parts, tmp_path):
    stream = jobs.read_folder_stream(spark, parts)
    query = jobs.start(
        stream.writeStream.format("parquet").option("path", str(tmp_path / "o")), str(tmp_path / "cp"), every="0 seconds"
    )
    jobs.stop_when_idle(query, idle_seconds=4, poll_seconds=0.5)
    assert not query.isActive
    assert spark.read.parquet(str(tmp_path / "o")).count() == 200


def test_kafka_options():
    options = M.kafka_options("h:1", pattern=TP.RAW_PATTERN, start="earliest", min_partitions=64)
    assert options["subscribePattern"] == TP.RAW_PATTERN and options["minPartitions"] == "64"
    assert M.kafka_options("h:1", topics=["a", "b"])["subscribe"] == "a,b"
    with pytest.raises(ValueError):
        M.kafka_options("h:1")


def test_required_fields_and_dates_are_checked(spark):
    good = '{"title":"t","content":"c","url":"http://x","press":"p","category":"it",' \
        '"published_at":"2024-01-01T00:00:00","collected_at":"2024-01-01T00:00:00"}'
    values = [good, good.replace('"press":"p",', ""), good.replace("2024-01-01T00:00:00", "soon", 1), "nonsense", None]
    df = spark.createDataFrame([("news.it.raw", v, i) for i, v in enumerate(values)], "topic string, value string, offset int")
    got = [r.reject_reason for r in M.checked(df).orderBy("offset").collect()]
    assert got == [None, "missing press", "bad published_at", "malformed json", "malformed json"]
