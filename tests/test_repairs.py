"""Nothing is lost or changed on the way: ids, caps, texts, ties, rejects."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.functions import text as X
from pulse.operators import dedup as D
from pulse.operators import filters as FL
from pulse.operators import report as R
from pulse.operators.sentiment import LexiconScorer, PandasScorer, score_thread_rows, score_threads
from pulse.operators.threads import nest_threads
from pulse.plans import common as CM
from pulse.plans import jobs as JB
from pulse.session import checkpoint_root, scratch_path
from pulse.sinks.files import stage_documents, write_topic
from pulse.sources import normalize as N
from pulse.sources import tables as TB
from pulse.sources.files import read_comments, read_topic_csv
from pulse.streaming import jobs as J
from pulse.streaming.catalogue import _label_comments

SF = "/root/testdata/sf0.001"

# Expected values written by hand, not taken from the pattern.
EMOJI = [
    ("⌚ ⏰ ▶️ ™️ \U0001F197 \U0001F170️ ‼️ ↗️ \U0001F004 \U0001F0CF ㊗️",
     ["⌚", "⏰", "▶️", "™️", "\U0001F197", "\U0001F170️", "‼️", "↗️", "\U0001F004", "\U0001F0CF", "㊗️"]),
    ("\U0001F3F4\U000E0067\U000E0062\U000E0065\U000E006E\U000E0067\U000E007F!", ["\U0001F3F4\U000E0067\U000E0062\U000E0065\U000E006E\U000E0067\U000E007F"]),
    ("✓ ★ ⬐ 1 # * a", []),
    ("#️⃣ 7⃣ \U0001F1EE\U0001F1F9", ["#️⃣", "7⃣", "\U0001F1EE\U0001F1F9"]),
    ("\U0001F468‍\U0001F469‍\U0001F467 \U0001F44D\U0001F3FD ❤️‍\U0001F525 ™",
     ["\U0001F468‍\U0001F469‍\U0001F467", "\U0001F44D\U0001F3FD", "❤️‍\U0001F525", "™"]),
]


@pytest.mark.parametrize("text,want", EMOJI)
def test_emoji(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(X.distinct_emoji("t")).first()[0]
    assert got == want


def test_large_threads_keep_all_comments_and_score_alike(spark):
    posts, comments = TB.source_threads(spark, SF)
    docs = nest_threads(posts, comments)
    sizes = {r[0]: r[1] for r in docs.select("content_id", F.size("comments")).collect()}
    want = {r[0]: r[1] for r in comments.groupBy("post_id").count().collect()}
    assert max(sizes.values()) >= 5 and {k: v for k, v in sizes.items() if v} == want
    lex = spark.createDataFrame(list(CM.TEST_LEXICON.items()) + [("commento", 1)], "word string, weight int")
    for scorer in (LexiconScorer({**CM.TEST_LEXICON, "commento": 1}), LexiconScorer(lex)):
        a = {r[0]: r[1] for r in score_thread_rows(posts, comments, scorer).select("content_id", "score").collect()}
        b = {r[0]: r[1] for r in score_threads(docs, scorer).select("content_id", "score").collect()}
        assert a == b
    with pytest.raises(ValueError):
        score_thread_rows(posts, comments, LexiconScorer({}, max_tokens=5))


def test_lexicon_forms_agree(spark):
    rows = spark.createDataFrame([("a", "trash trash"), ("a", "nice"), (None, "trash"), (None, "trash"), ("b", None)], "content_id string, t string")
    table = spark.createDataFrame([("trash", -1), ("trash", -1), ("nice", 1)], "word string, weight int")
    inline = sorted(((r.content_id, r.t, r.score) for r in LexiconScorer({"trash": -2, "nice": 1}).label(rows, "t").collect()), key=str)
    joined = sorted(((r.content_id, r.t, r.score) for r in LexiconScorer(table).label(rows, "t").collect()), key=str)
    assert inline == joined and [r[2] for r in inline] == [1, -4, 0, -2, -2]


def test_first_phase_wins_for_any_number_of_phases(spark):
    at = dt.datetime(2025, 1, 1, 12, tzinfo=dt.timezone.utc)
    lab = spark.createDataFrame([("x", "Positive", at)], "social_media string, sentiment string, publish_date timestamp")
    two = [("a", "2025-01-01T00:00:00", "2025-01-02T00:00:00"), ("b", "2025-01-01T06:00:00", "2025-01-03T00:00:00")]
    many = two + [(f"p{i}", f"20{30 + i % 60:02d}-01-01T00:00:00", f"20{30 + i % 60:02d}-01-02T00:00:00") for i in range(66)]
    for phases in (two, many):
        r = R.compare_phases(lab, phases).first()
        assert (r.share_a, r.share_b) == (100.0, 0.0)


def test_keep_first_needs_an_arrival_order(spark):
    df = spark.createDataFrame([("a", 1, i) for i in range(8)], "content_id string, publish_date int, like_count int")
    with pytest.raises(ValueError):
        D.keep_first(df, ["content_id"], ["content_id"])
    assert D.keep_first(df, ["content_id"], ["like_count"]).first().like_count == 0


def test_skip_seen_matches_null_parts(spark):
    rows = spark.createDataFrame([("x", None, "a"), ("x", "s", "b")], "social_media string, scope string, content_id string")
    assert D.skip_seen(rows, rows).count() == 0


def test_topic_csv_is_loss_free(spark):
    notes = [" a ", " ", "", 'q"u,o', "two\nlines", None, "\\N x", "\ttab", "#c", "'x'"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(notes)], "id int, note string")
    path = scratch_path(spark, "csv")
    write_topic(df, path)
    assert [r.note for r in read_topic_csv(spark, path, df.schema).orderBy("id").collect()] == notes
    assert read_topic_csv(spark, path + "_none", df.schema).count() == 0


def test_malformed_pages_and_payloads_are_rejected(spark):
    pages = spark.createDataFrame([("{broken",), (None,), ("{}",), ('{"query": "q", "videoId": "v", "items": []}',)], "payload string")
    rows = N.normalize_comment_pages(pages)
    ok, rejected = FL.quarantine(rows)
    assert ok.count() == 0 and sorted(r.reason for r in rejected.collect()) == ["malformed"] * 3
    docs = N.normalize_thread_payload(spark.createDataFrame([("{broken",), ('{"comments": []}',)], "payload string"))
    ok, rejected = FL.quarantine(docs)
    assert ok.count() == 0 and [r.reason for r in rejected.collect()] == ["malformed"] * 2


def _staged(spark):
    """Three comments without id, one without time, one blank, two good."""
    rows = CM.comments(spark, SF).orderBy("content_id").limit(7).withColumn("n", F.row_number().over(Window.orderBy("content_id")))
    rows = rows.withColumn("content_id", F.when(F.col("n") > 3, F.col("content_id")))
    rows = rows.withColumn("publish_date", F.when(F.col("n") != 4, F.col("publish_date")))
    return rows.withColumn("comment_raw_text", F.when(F.col("n") == 5, " ").otherwise(F.col("comment_raw_text"))).drop("n")


@pytest.mark.parametrize("mode", ["key", "batch"])
def test_stored_and_rejected_are_all_that_landed(spark, mode):
    base = scratch_path(spark, f"all_{mode}")
    docs = _staged(spark)
    stage_documents(docs, f"{base}/staged")
    for _ in range(2):  # the second landing restages everything
        src = read_comments(spark, f"{base}/staged", streaming=True, max_files_per_trigger=1)
        J.label_stream(src, _label_comments, f"{base}/store", f"{base}/rejects", f"{base}/ckpt", idempotency=mode)
        stage_documents(docs, f"{base}/staged")
    store, rejects = spark.read.parquet(f"{base}/store"), spark.read.parquet(f"{base}/rejects")
    assert store.count() == 2 and set(N.ALL_COLUMNS) <= set(store.columns)
    assert store.filter("labelled_at is null").count() == 0
    assert sorted(r.reason for r in rejects.collect()) == ["bad_time", "blank_text", "missing_id", "missing_id", "missing_id"]


def test_batch_job_writes_rejects_and_whole_documents(spark):
    base = scratch_path(spark, "batch_all")
    stage_documents(_staged(spark), f"{base}/staged")
    for _ in range(2):
        JB.label_staged(spark, None, f"{base}/staged", f"{base}/store", None, _label_comments)
    assert spark.read.parquet(f"{base}/store").count() == 2
    assert spark.read.parquet(f"{base}/store_rejects").count() == 5
    tables = JB.report(spark, f"{base}/store", f"{base}/report")
    assert set(tables) >= {"item_series", "terms_by_label", "collocations_by_label", "texts_by_label", "summary"}
    assert spark.read.parquet(f"{base}/report/item_series").count() == 2


def test_running_counts_count_a_document_once(spark):
    base = scratch_path(spark, "counts_once")
    docs = CM.comments(spark, SF).limit(20)
    for _ in range(2):
        stage_documents(docs, f"{base}/staged")
        src = read_comments(spark, f"{base}/staged", streaming=True, max_files_per_trigger=1)
        lab = _label_comments(FL.quarantine(src)[0]).select("content_id", "social_media", "sentiment")
        J.running_label_counts(lab, f"{base}/counts", f"{base}/ckpt")
    assert spark.read.parquet(f"{base}/counts").agg(F.sum("n")).first()[0] == 20


def test_a_failing_text_takes_no_other_with_it(spark):
    import pandas as pd

    def model(texts: pd.Series) -> pd.Series:
        if (texts == "bad").any():
            raise RuntimeError("no")
        return pd.Series([4] * len(texts), index=texts.index)

    rows = spark.createDataFrame([(f"t{i}",) for i in range(30)] + [("bad",)], "t string").coalesce(1)
    out = {r.t: r.defaulted for r in PandasScorer(model).label(rows, "t").collect()}
    assert out.pop("bad") and not any(out.values())
    loaded = PandasScorer(lambda m, texts: [m] * len(texts), load=lambda: 3).label(rows, "t")
    assert {r.ordinal for r in loaded.collect()} == {3}


def test_an_unreadable_store_is_no_empty_store(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        J.read_or_none(spark, str(tmp_path))
    assert J.read_or_none(spark, str(tmp_path / "none")) is None


def test_checkpoint_folder_is_set(spark):
    assert checkpoint_root(spark)
