"""Work that the large queries must not repeat (findings of round 3)."""

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pulse.functions import text as X
from pulse.llm import ctw
from pulse.llm.storage import ROWS_PER_BATCH, ship_package, texts_of
from pulse.operators import dedup as D
from pulse.operators import terms as TR
from pulse.operators.threads import thread_text
from pulse.plans import catalogue as PC
from pulse.schema import COMMENT_STRUCT
from pulse.sources import tables as TB
from pulse.streaming import catalogue as SC
from pulse.streaming import jobs as J

DOCS = [(i, f"{w} thing {w} of the trash tion word{i % 3}", "en" if i % 2 else "it", f"s{i % 2}", 30) for i, w in enumerate(["Alpha", "beta", "Gamma", "delta"] * 3)]
TURNS = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of talk {c} ble") for c in range(3) for t in range(3)]


def _tables(spark, path):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(os.path.join(path, "documents.parquet"))
    spark.createDataFrame(TURNS, "conv_id long, turn int, role string, text string").write.parquet(os.path.join(path, "conversations.parquet"))
    return path


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_report_tables_reads_stored_labels(spark, tmp_path, monkeypatch):
    seen = {}
    write = SC.write_report
    monkeypatch.setattr(SC, "write_report", lambda tables, path: (seen.update(tables), write(tables, path)))
    assert SC.report_tables(spark, _tables(spark, str(tmp_path))).count() > 0
    assert len(seen) == 3
    for table in seen.values():
        assert "regexp_extract_all" not in _plan(table)


def test_waves_are_scored_once(spark, tmp_path, monkeypatch):
    seen = []
    land = SC._land_in_order
    monkeypatch.setattr(SC, "_land_in_order", lambda rows, *a: (seen.append(_plan(rows)), land(rows, *a))[1])
    SC.stream_sentiment_over_time(spark, _tables(spark, str(tmp_path))).count()
    assert len(seen) == 1 and "regexp" not in seen[0]


def test_final_report_counts_words_and_pairs_once(spark, tmp_path, monkeypatch):
    store = spark.createDataFrame([(f"c{i}", "YouTube", "Neutral", t[1], None) for i, t in enumerate(DOCS)],
                                  "content_id string, social_media string, sentiment string, comment_raw_text string, publish_date timestamp")
    store.write.parquet(str(tmp_path / "store"))
    tables = J.final_report(spark, str(tmp_path / "store"))
    for name in ("terms_by_label", "collocations_by_label"):
        assert "regexp_extract_all" not in _plan(tables[name])
    alone = TR.term_frequency(store.withColumnRenamed("comment_raw_text", "text"), ["social_media", "sentiment"])
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, tables["terms_by_label"].collect()))


def test_big_threads_reads_cleaned_rows(spark, tmp_path):
    for rows in TB.source_threads(spark, _tables(spark, str(tmp_path))):
        assert "regexp_replace" not in _plan(rows)
    assert PC.big_threads(spark, str(tmp_path)).count() == 2


def test_thread_text_copies_nothing_per_comment(spark):
    df = spark.sql("SELECT 'p' AS comment_raw_text, array('a', ' ', NULL, 'b') AS texts")
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in COMMENT_STRUCT.fields]
    full = lambda t: F.struct(*[t.alias(c.name) if c.name == "comment_raw_text" else o for c, o in zip(COMMENT_STRUCT.fields, others)])
    df = df.select("comment_raw_text", F.transform("texts", full).alias("comments"))
    glued = df.select(thread_text(comments=F.col("comments")).alias("t"))
    assert glued.first().t == "p commento:a commento:b"
    assert "aggregate(" not in _plan(glued)


def test_joins_sort_by_word_first(spark, monkeypatch):
    df = spark.createDataFrame([("g", t[1]) for t in DOCS], "g string, text string")
    plan = TR.collocations(df, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"Join Inner, \(+(\w+)#", plan)
    assert "w1" in keys and "w2" in keys
    seen = {}
    kept = TR.materialised
    monkeypatch.setattr(TR, "materialised", lambda d, name: (seen.setdefault(name, _plan(d)), kept(d, name))[1])
    got = TR.cloud_list(df, ["g"], min_llr=-1.0).collect()
    assert got and "cloud_counted" in seen


def test_replay_picks_among_new_keys_alone(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    spark.createDataFrame([("YouTube", "s", f"c{i % 4}", i) for i in range(8)], "social_media string, scope string, content_id string, at long").write.json(f"{base}/in")
    given = []
    first = D.keep_first
    monkeypatch.setattr(D, "keep_first", lambda df, *a: (given.append(df.count()), first(df, *a))[1])
    for run in ("a", "b"):
        src = spark.readStream.schema("social_media string, scope string, content_id string, at long").json(f"{base}/in")
        J.ingest_stream(src, f"{base}/store", f"{base}/ledger", f"{base}/ckpt_{run}", ["at"])
    assert given == [8, 0]
    assert sorted(r.at for r in spark.read.parquet(f"{base}/store").collect()) == [0, 1, 2, 3]


def test_clean_comment_is_the_plain_three_steps(spark):
    texts = ["a b", " a  b ", "\ta\n\nb\x1c", " x   y　", "see http://x.y/z  now", "www. x www.a", "https:// b", "x\u0085 \u0085y", "", " ", "a b", "a  b  c", "café  \x1f z", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.coalesce("t", F.lit(""))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, X.COMMENT_URL, " "), X.WS_RUN, " "), X.EDGE_SPACE, "")
    for r in df.select(X.clean_comment_text("t").alias("a"), plain.alias("b")).collect():
        assert r.a == r.b
    assert "trim(" in df.select(X.clean_comment_text("t").alias("a"))._jdf.queryExecution().optimizedPlan().toString()


def test_term_tokens_keep_their_rules(spark):
    df = spark.createDataFrame([("It's 12's 2025 ٣٤ x9 9x dogs' A's _1 '12 café's BOB'S",)], "t string")
    r = df.select(X.term_tokens("t").alias("l"), X.cased_tokens("t").alias("c")).first()
    assert r.l == ["it", "x9", "9x", "dogs'", "a", "_1", "café", "bob"]
    assert r.c == ["It", "x9", "9x", "dogs'", "A", "_1", "café", "BOB"]


def test_workers_hold_one_range_of_texts(spark):
    ship_package(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= ROWS_PER_BATCH
    column = pa.array([b"aa", b"", b"bbb", b"c"], pa.binary())
    cut = list(texts_of(column, lambda sizes: ctw.text_ranges(sizes, 2)))
    assert [x for _, _, part in cut for x in part] == column.to_pylist() and len(cut) > 1
    parts = [(np.array([1, 3]), np.array([2, 1])), (np.array([3, 5]), np.array([4, 1]))]
    codes, counts = ctw.merged(parts)
    assert codes.tolist() == [1, 3, 5] and counts.tolist() == [2, 5, 1] and parts == []
