"""Streaming equals batch; a replay from a fresh checkpoint adds nothing."""

from pulse.plans import catalogue as CAT
from pulse.streaming import catalogue as SC

SF = "/root/testdata/sf0.001"


def test_stream_label_equals_batch(spark):
    stream = sorted(tuple(r) for r in SC.stream_label(spark, SF, files_per_trigger=2).collect())
    batch = sorted(tuple(r) for r in CAT.thread_sentiment(spark, SF).collect())
    assert stream == batch


def test_stream_ingest_keys_and_ledger(spark):
    out = SC.stream_ingest(spark, SF)
    keys = out.select("scope", "content_id").distinct().count()
    assert out.count() == keys  # replay added no duplicate
    batch = CAT.dedup_first(spark, SF).count()
    assert keys == batch
    assert out.first()["ledger_rows"] == keys


def test_stream_counts_equal_batch(spark):
    stream = sorted(tuple(r) for r in SC.stream_label_counts(spark, SF, files_per_trigger=2).collect())
    batch = sorted(tuple(r) for r in CAT.label_counts(spark, SF).collect())
    assert stream == batch


def test_stateful_ingest_multi_batch(spark):
    out = SC.stream_ingest_stateful(spark, SF)
    assert out.count() == out.distinct().count() == CAT.dedup_first(spark, SF).count()


def test_crash_between_store_and_commit_does_not_duplicate(spark):
    # A batch whose rows reached the store but whose commit never happened is
    # replayed: the keyed append skips what is already stored.
    from pulse.session import scratch_path
    from pulse.sinks.files import stage_documents
    from pulse.sources.files import read_threads
    from pulse.plans import common as CM
    from pulse.streaming import jobs as J
    base = scratch_path(spark, "crash")
    threads = CM.threads(spark, SF)
    stage_documents(threads.repartition(3, "content_id"), f"{base}/staged")
    partial = SC._label_threads(threads).limit(7)
    J.append_new(partial, f"{base}/store", ["content_id"])
    src = read_threads(spark, f"{base}/staged", streaming=True, max_files_per_trigger=1)
    J.label_stream(src, SC._label_threads, f"{base}/store", f"{base}/rejects", f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/store")
    assert out.count() == out.select("content_id").distinct().count() == threads.count()


def test_stream_rejects_malformed_once(spark):
    from pyspark.sql import functions as F
    from pulse.session import scratch_path
    from pulse.sinks.files import stage_documents
    from pulse.sources.files import read_threads
    from pulse.plans import common as CM
    from pulse.streaming import jobs as J
    base = scratch_path(spark, "rejects")
    threads = CM.threads(spark, SF)
    stage_documents(threads.repartition(2, "content_id"), f"{base}/staged")
    spark.range(1).select(F.lit('{"content_id": "x", "comments": [').alias("value")) \
        .write.mode("append").text(f"{base}/staged")
    spark.range(1).select(F.lit('{}').alias("value")).write.mode("append").text(f"{base}/staged")
    for run in ("a", "b"):
        src = read_threads(spark, f"{base}/staged", streaming=True, max_files_per_trigger=1)
        J.label_stream(src, SC._label_threads, f"{base}/store", f"{base}/rejects", f"{base}/ckpt_{run}")
    store = spark.read.parquet(f"{base}/store")
    rejects = spark.read.parquet(f"{base}/rejects")
    assert store.count() == threads.count()
    assert sorted(r[0] for r in rejects.select("reason").collect()) == ["empty", "malformed"]
