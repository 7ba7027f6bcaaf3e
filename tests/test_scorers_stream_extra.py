"""T2(c) plug-in scorer, W4 bounded dedup, A12 streaming metrics, K5."""

import pandas as pd
from pyspark.sql import functions as F

from pulse.operators.sentiment import LexiconScorer, PandasScorer
from pulse.session import scratch_path
from pulse.sources import tables as TB
from pulse.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def test_pandas_scorer_and_failures(spark):
    df = spark.createDataFrame([("a", "good day"), ("b", "bad day"), ("c", "  ")], "content_id string, t string")

    def model(texts: pd.Series) -> pd.Series:
        return texts.str.contains("good").map({True: 4, False: 0})

    got = {r["content_id"]: (r["sentiment"], r["defaulted"]) for r in PandasScorer(model).label(df, "t").collect()}
    assert got == {"a": ("Very Positive", False), "b": ("Very Negative", False), "c": ("Neutral", True)}

    def broken(texts: pd.Series) -> pd.Series:
        raise RuntimeError("model down")

    out = PandasScorer(broken).label(df, "t").collect()
    assert {r["sentiment"] for r in out} == {"Neutral"} and all(r["defaulted"] for r in out)


def test_lexicon_join_path_equals_inline(spark):
    df = spark.createDataFrame([("a", "Trash trash nice"), ("b", "nice nice"), ("c", "")], "content_id string, t string")
    lex = {"trash": -2, "nice": 1}
    inline = {r["content_id"]: r["score"] for r in LexiconScorer(lex).label(df, "t").collect()}
    table = spark.createDataFrame(list(lex.items()), "word string, weight int")
    scorer = LexiconScorer(table)
    scorer.lexicon = table  # force the explode + join path
    joined = {r["content_id"]: r["score"] for r in scorer.label(df, "t").collect()}
    assert inline == joined == {"a": -3, "b": 2, "c": 0}


def test_watermark_dedup_and_cycle_metrics(spark):
    base = scratch_path(spark, "wm_test")
    obs = TB.observations(spark, SF)
    obs.repartitionByRange(4, "arrival_ts").write.json(f"{base}/landing")
    src = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", 1).json(f"{base}/landing")
    deduped = J.dedup_within_watermark(src, "arrival_ts", "365 days")
    q = (deduped.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    keys = obs.select("social_media", "scope", "content_id").distinct().count()
    assert out.count() == keys  # a delay longer than the data: exactly one row per key

    src2 = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", 1).json(f"{base}/landing")
    q2 = J.ingest_stream(src2, f"{base}/store", f"{base}/ledger", f"{base}/ckpt2", ["arrival_ts", "event_id"])
    metrics = q2.lastProgress["observedMetrics"]["cycle"]
    assert int(metrics["items"]) > 0


def test_label_stream_batch_idempotency_restart(spark):
    from pulse.plans import common as CM
    from pulse.sinks.files import stage_documents
    from pulse.sources.files import read_threads
    from pulse.streaming.catalogue import _label_threads
    base = scratch_path(spark, "label_batch_mode")
    stage_documents(CM.threads(spark, SF).repartition(4, "content_id"), f"{base}/staged")
    for _ in range(2):  # second run restarts on the same checkpoint: nothing new
        src = read_threads(spark, f"{base}/staged", streaming=True, max_files_per_trigger=1)
        J.label_stream(src, _label_threads, f"{base}/store", f"{base}/rejects", f"{base}/ckpt",
                       idempotency="batch")
    out = spark.read.parquet(f"{base}/store")
    assert out.count() == out.select("content_id").distinct().count() == CM.threads(spark, SF).count()


def test_topic_filter_prunes_partitions(spark):
    from pulse.operators.filters import topic_scope
    from pulse.plans import common as CM
    from pulse.sinks.files import write_parquet
    base = scratch_path(spark, "topic_parts")
    rows = CM.comments(spark, SF).select("content_id", "social_media", "topic", "scope")
    write_parquet(rows, base, ["social_media", "topic"])
    picked = topic_scope(spark.read.parquet(base), topic="en")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "(topic" in plan
    assert picked.count() == rows.filter("topic = 'en'").count()


def test_trained_scorer_held_out(spark):
    from pulse.operators.sentiment import TrainedScorer
    from pulse.plans import common as CM
    sf = "/root/testdata/sf0.01"
    rows = CM.comments(spark, sf)
    labels = TB.table(spark, sf, "labels").select(
        F.concat(F.lit("yt_comm_"), F.col("doc_id").cast("string")).alias("content_id"),
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 2).otherwise(3).alias("target"))
    data = rows.join(labels, "content_id").withColumn("_fold", F.pmod(F.xxhash64("content_id"), F.lit(5)))
    train, test = data.filter("_fold <> 0"), data.filter("_fold = 0")
    model = TrainedScorer(num_features=1 << 14, max_iter=50).fit(train, "comment_raw_text", "target")
    scored = model.label(test, "comment_raw_text")
    acc = scored.select(F.avg((F.col("ordinal") == F.col("target")).cast("double"))).first()[0]
    majority = test.groupBy("target").count().agg(F.max("count") / F.sum("count")).first()[0]
    # held-out accuracy must not fall below always answering the majority
    # class (the training fit itself proves nothing)
    assert acc >= majority


def test_large_lexicon_inline_equals_join(spark):
    lex = {f"w{i}": (i % 5) - 2 for i in range(20000)}
    lex.update({"don't": -3, "back\\slash": 2, "nice": 1})
    df = spark.createDataFrame([("a", "w1 w2 w3 don't nice"), ("b", "w4 w4 back\\slash"), ("c", "zzz")],
                               "content_id string, t string")
    inline = LexiconScorer(lex)
    assert inline.inline
    a = {r["content_id"]: r["score"] for r in inline.label(df, "t").collect()}
    table = spark.createDataFrame(list(lex.items()), "word string, weight int")
    joined = LexiconScorer(table)
    joined.lexicon = table
    b = {r["content_id"]: r["score"] for r in joined.label(df, "t").collect()}
    # "back\slash" cannot match a token (tokens hold no backslash); it only
    # checks that such a word does not break the generated expression
    assert a == b == {"a": -1 + 0 + 1 - 3 + 1, "b": 2 + 2, "c": 0}
