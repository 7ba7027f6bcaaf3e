"""Bucketed ledger, state per micro-batch, keyed staging, reject queue, event-time windows."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from pulse.operators import dedup as D
from pulse.operators import ledger as LG
from pulse.plans import common as CM
from pulse.session import scratch_path, settled
from pulse.sinks.files import latest_staged, stage_keyed
from pulse.sources.files import read_comments
from pulse.streaming import jobs as J
from pulse.streaming import labelling as LB
from pulse.streaming import windows as WN
from pulse.streaming.catalogue import _label_comments
from pulse.streaming.state import BatchTable

SF = "/root/testdata/sf0.001"
KEYS = "social_media string, scope string, content_id string"


def keys(spark, ids, scope="s"):
    return spark.createDataFrame([("p", scope, i) for i in ids], KEYS)


def scanned(df):
    """Rows that the Parquet reader handed out, and the files it was given."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size())), len(df.inputFiles())


def forget_last_commit(checkpoint):
    """As if the driver was lost after the last micro-batch's work and before its commit."""
    folder = os.path.join(checkpoint, "commits")
    last = max((n for n in os.listdir(folder) if n.isdigit()), key=int)
    for n in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(folder, n)):
            os.remove(os.path.join(folder, n))


def test_ledger_reads_stay_flat_over_ten_triggers(spark):
    path = scratch_path(spark, "ledger")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = []
        for k in range(10):
            batch = keys(spark, [f"id-{k}-{i}" for i in range(100)])
            look = LG.Ledger(spark, path, buckets=4).lookup(batch, f"r/{k}")
            found = look.entries()
            read.append((0, 0) if found is None else scanned(found))
            fresh = look.unseen()
            assert fresh.count() == 100
            look.record(fresh)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(files for _, files in read) <= 4 * (LG.FILES + 1)
    # 900 keys are recorded in the end; no id of a batch is among them, and the Bloom filters show it
    assert max(rows for rows, _ in read[5:]) <= 250
    assert LG.Ledger(spark, path).buckets == 4 and LG.Ledger(spark, path).read().count() == 1000


def test_ledger_membership(spark):
    path = scratch_path(spark, "ledger")
    first = keys(spark, ["a", "b", None])
    assert LG.Ledger(spark, path).read() is None and LG.Ledger(spark, path).unseen(first).count() == 3
    LG.Ledger(spark, path).record(first, "r/0")
    book = LG.Ledger(spark, path)
    assert book.unseen(first).count() == 0 and book.unseen(keys(spark, ["a"], "other")).count() == 1
    # the batch that recorded them finds them new again, another one does not
    assert book.unseen(first, "r/0").count() == 3 and book.unseen(first, "r/1").count() == 0
    book.record(first, "r/0")
    assert book.read().count() == 3
    many = keys(spark, [f"x{i}" for i in range(LG.IDS_PUSHED + 50)])
    book.record(many, "r/2")
    assert book.lookup(many).ids is None and book.unseen(many).count() == 0


def test_merge_keeps_all_keys(spark, monkeypatch):
    monkeypatch.setattr(LG, "FILES", 2)
    path = scratch_path(spark, "ledger")
    book = LG.Ledger(spark, path, buckets=2)
    deleted = []
    real = LG.folders.delete
    for k in range(5):
        # the last merge is cut before it deletes anything
        monkeypatch.setattr(LG.folders, "delete", (lambda s, p: deleted.append(p)) if k == 4 else real)
        book.record(keys(spark, [f"{k}-{i}" for i in range(20)]), f"r/{k}")
    assert deleted and book.read().count() == 100
    assert book.unseen(keys(spark, [f"{k}-{i}" for k in range(5) for i in range(20)])).count() == 0


def test_batch_table_versions(spark):
    table = BatchTable(spark, scratch_path(spark, "state"))
    assert table.before("a", 0) is None and table.latest() is None
    for k in range(6):
        before = table.before("a", k)
        assert (before.first().n if before else None) == (k - 1 if k else None)
        table.write(spark.range(1).select(F.lit(k).alias("n")), "a", k)
    assert table.before("a", 5).first().n == 4            # the replay of batch 5 starts where it did
    table.write(spark.range(1).select(F.lit(50).alias("n")), "a", 5)
    assert table.latest().first().n == 50 and table.before("b", 0).first().n == 50


def test_ingest_replays_an_uncommitted_batch(spark):
    base = scratch_path(spark, "ingest")
    rows = keys(spark, ["a", "b", "c", "a"]).withColumn("at", F.monotonically_increasing_id())
    rows.coalesce(1).write.json(f"{base}/landing")
    for lost in (False, True, True):
        if lost:
            forget_last_commit(f"{base}/ckpt")
        src = spark.readStream.schema(rows.schema).json(f"{base}/landing")
        J.ingest_stream(src, f"{base}/store", f"{base}/ledger", f"{base}/ckpt", ["at"])
        assert sorted(r.content_id for r in spark.read.parquet(f"{base}/store").collect()) == ["a", "b", "c"]
        assert LG.Ledger(spark, f"{base}/ledger").read().count() == 3


def doc(spark, rows):
    """Comments from (id, text, has a time)."""
    like = CM.comments(spark, SF).limit(1).drop("content_id", "comment_raw_text", "publish_date")
    at = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
    made = spark.createDataFrame([(i, t, at if ok else None) for i, t, ok in rows], "content_id string, comment_raw_text string, publish_date timestamp")
    return made.crossJoin(F.broadcast(like))


def test_last_staged_version_stands(spark):
    base = scratch_path(spark, "staged")
    stage_keyed(doc(spark, [("a", "one", True), ("b", "one", True), (None, "x", True), (None, "x", True)]), f"{base}/s")
    stage_keyed(doc(spark, [("a", "two", True)]), f"{base}/s")
    got = latest_staged(read_comments(spark, f"{base}/s", sequence=True))
    assert sorted(((r.content_id, r.comment_raw_text, r.staged_seq) for r in got.collect()), key=str) == [("a", "two", 2), ("b", "one", 1), (None, "x", 1)]


@pytest.fixture
def cycles(spark):
    base = scratch_path(spark, "cycles")

    def run(rows=None, checkpoint="ckpt"):
        if rows:
            stage_keyed(doc(spark, rows), f"{base}/s", position=F.monotonically_increasing_id())
        src = read_comments(spark, f"{base}/s", streaming=True, sequence=True)
        LB.label_cycles(src, _label_comments, f"{base}/out", f"{base}/{checkpoint}")
        store = spark.read.parquet(f"{base}/out/store").orderBy("item")
        waiting = {r.content_id: (r.reason, r.attempts, r.last_rejected > r.first_rejected) for r in LB.waiting_rejects(spark, f"{base}/out").collect()}
        return [(r.content_id, r.comment_raw_text, r.item) for r in store.collect()], waiting
    run.base = base
    return run


def test_rejects_are_tried_again_and_leave_when_accepted(spark, cycles):
    stage_keyed(doc(spark, [("a", "old", True)]), f"{cycles.base}/s")
    store, waiting = cycles([("a", "first", True), ("b", "no time", False), ("c", " ", True)])
    assert store == [("a", "first", 1)] and waiting == {"b": ("bad_time", 1, False), "c": ("blank_text", 1, False)}
    store, waiting = cycles([("b", "repaired", True), ("a", "too late", True), ("d", "new", True)])
    assert {s[:2] for s in store[1:]} == {("b", "repaired"), ("d", "new")} and [s[2] for s in store] == [1, 2, 3]
    assert waiting == {"c": ("blank_text", 2, True)}
    before = store
    forget_last_commit(f"{cycles.base}/ckpt")             # the replay changes nothing, attempts included
    assert cycles() == (before, {"c": ("blank_text", 2, True)})
    store, waiting = cycles(checkpoint="fresh")           # all of it again: labelled ids stay as they are
    assert store == before and waiting == {"c": ("blank_text", 3, True)}
    assert LB.label_totals(spark, f"{cycles.base}/out").agg(F.sum("n")).first()[0] == 3
    series = J.final_report(spark, f"{cycles.base}/out/store")["item_series"]
    assert sorted((r.item, r.content_id) for r in series.collect()) == [(n, i) for i, _, n in before]
    assert "Exchange" not in series._jdf.queryExecution().executedPlan().toString()      # read, not made


def bytes_below(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


def shuffled(spark):
    """Bytes that the session's shuffles have on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).length() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_"))


def test_cycles_hold_texts_once(spark, cycles):
    rng = random.Random(4)
    rows = [(f"id{i}", "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=20_000)), i % 4 > 0) for i in range(200)]
    texts = sum(len(t) for _, t, _ in rows)
    for _ in range(2):
        stage_keyed(doc(spark, rows), f"{cycles.base}/s")
    before = shuffled(spark)
    for checkpoint in ("ckpt", "fresh"):
        src = read_comments(spark, f"{cycles.base}/s", streaming=True, sequence=True)
        LB.label_cycles(src, _label_comments, f"{cycles.base}/out", f"{cycles.base}/{checkpoint}")
    # staged twice as packed documents; no shuffle of whole documents outlives its query
    assert bytes_below(f"{cycles.base}/s") < 1.5 * texts
    for _ in range(50):                                   # files are removed in the background
        if shuffled(spark) - before < 0.25 * texts:
            break
        time.sleep(0.2)
    assert shuffled(spark) - before < 0.25 * texts
    assert spark.read.parquet(f"{cycles.base}/out/store").count() == 150
    assert {r.attempts for r in LB.waiting_rejects(spark, f"{cycles.base}/out").collect()} == {2}


def test_marked_rows_are_those_named(spark, monkeypatch):
    rows = spark.range(200_000, numPartitions=3).withColumn("n", F.monotonically_increasing_id())
    some = rows.where("id % 7 = 0 or id in (0, 1, 199999)").select("n").union(spark.sql("select cast(null as long)"))
    want = {i for i in range(200_000) if i % 7 == 0 or i in (1, 199_999)}
    found = D.marked(rows, some, "n")
    assert settled(rows) is rows and settled(rows.repartition(2, "id")).count() == 200_000
    assert "ExistingRDD" in settled(rows.repartition(2, "id"))._jdf.queryExecution().executedPlan().toString()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.columns == ["id", "n"] and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {r.id for r in found.collect()} == want and found.count() == len(want)
    assert D.marked(rows, some.limit(0), "n").count() == 0
    monkeypatch.setattr(D, "BITMAPS", 1)                  # shared bitmaps let more pass, none is missed
    assert want < {r.id for r in D.marked(rows, some, "n").collect()}


def test_last_staged_among_equal_places(spark, cycles):
    """Where the order does not decide, the hash of the content does, whole or short."""
    for text in ("one", "two", "three"):
        (doc(spark, [("a", text, True), ("b", text, False)]).withColumn("staged_seq", F.lit(1)).withColumn("staged_pos", F.lit(1))
         .write.mode("append").json(f"{cycles.base}/s"))
    want = {r.content_id: r.comment_raw_text for r in latest_staged(read_comments(spark, f"{cycles.base}/s", sequence=True)).collect()}
    store, waiting = cycles()
    kept = {r.content_id: r.comment_raw_text for r in LB.waiting_rejects(spark, f"{cycles.base}/out").collect()}
    assert {i: t for i, t, _ in store} | kept == want and set(waiting) == {"b"}


def test_windows_late_rows_and_replay(spark):
    base = scratch_path(spark, "windows")

    def at(h):
        return dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=h)
    schema = "social_media string, sentiment string, publish_date timestamp"
    waves = [[0.5, 0.6, 3.1], [2.5, 5.2, 0.7], [3.9, 9.0], [4.2, 8.1]]
    # watermarks of one hour: none, 2:06, 4:12, 8:00; a window counts while its end is above
    for k, hours in enumerate(waves):
        rows = [("p", "Positive", at(h)) for h in hours] + [("p", "Negative", None)] * (k == 1)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{base}/landing")
        src = spark.readStream.schema(schema).json(f"{base}/landing")
        for lost in (False, True):
            if lost:
                forget_last_commit(f"{base}/ckpt")
            WN.windowed_counts(src, base, f"{base}/ckpt")
    got = {(r.window_start.hour, r.n, r.status) for r in WN.read_windows(spark, base).withColumn(
        "window_start", F.col("window_start")).selectExpr("window_start", "n", "status").collect()}
    late = sorted((r.publish_date.hour if r.publish_date else -1) for r in WN.read_late(spark, base).collect())
    assert {(n, s) for _, n, s in got} and sum(n for _, n, _ in got) + len(late) == 11
    assert late == [-1, 0, 3, 4]
    assert got == {(0, 2, "closed"), (3, 1, "closed"), (2, 1, "closed"), (5, 1, "closed"), (8, 1, "open"), (9, 1, "open")}


def test_topic_dataset_grows_by_new_rows_only(spark):
    from pulse.plans.jobs import append_topic
    path = f"{scratch_path(spark, 'topic')}/data"
    rows = doc(spark, [("a", "first", True), ("b", "first", True), ("a", "again", True)]).withColumn("position", F.monotonically_increasing_id())
    assert append_topic(rows.orderBy("position"), path, ["position", "comment_raw_text"]).count() == 2
    files = set(spark.read.parquet(path).inputFiles())
    more = doc(spark, [("b", "later", True), ("c", "later", True)]).withColumn("position", F.lit(0).cast("long"))
    assert append_topic(more, path, ["position", "comment_raw_text"]).count() == 1
    stored = spark.read.parquet(path)
    assert files < set(stored.inputFiles())               # what was written before is not written again
    assert {r.content_id: r.comment_raw_text for r in stored.collect()}["b"] == "first"
    assert stored.count() == 3 and stored.select("cycle").distinct().count() == 2


def test_one_instant_a_run(spark):
    from pulse.plans import jobs as JB
    from pulse.sources import tables as TB
    base = scratch_path(spark, "instant")
    posts, comments = TB.raw_thread_payload(spark, SF)
    flat = JB.collect_threads(spark, posts, comments, f"{base}/ledger", f"{base}/staged", None, None, topic_store=f"{base}/topic")
    staged = spark.read.json(f"{base}/staged").select("observation_time").distinct().collect()
    kept = spark.read.parquet(f"{base}/topic").select(F.date_format("observation_time", "yyyy-MM-dd HH:mm:ss.SSS")).distinct().collect()
    assert len(staged) == len(kept) == 1 and spark.read.parquet(f"{base}/topic").count() == flat.count()


def test_many_phases_as_a_table_equal_the_case_form(spark):
    import random
    from pulse.operators import report as R
    rng = random.Random(6)
    base = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
    times = [None] + [base + dt.timedelta(seconds=rng.randint(0, 50_000)) for _ in range(300)] + [base - dt.timedelta(days=30_000)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, publish_date timestamp")
    phases = []
    for k in range(10_000):
        start = base + dt.timedelta(seconds=rng.randint(-100, 50_000), microseconds=rng.randint(0, 3))
        phases.append((f"p{k}", start, start + rng.choice([dt.timedelta(0), dt.timedelta(microseconds=1), dt.timedelta(seconds=rng.randint(1, 3)), dt.timedelta(hours=rng.randint(0, 30) * (k > 9_000))]), k))
    table = spark.createDataFrame(phases, "phase string, start timestamp, end timestamp, rank int")
    tagged = R.tag_phases(rows, table)
    assert "NestedLoop" not in tagged._jdf.queryExecution().executedPlan().toString()
    want = {i: next((n for n, a, b, _ in phases if t is not None and a <= t < b), None) for i, t in enumerate(times)}
    assert {r.i: r.phase for r in tagged.collect()} == want and len([v for v in want.values() if v]) > 200
    few = [(n, a.isoformat(), b.isoformat()) for n, a, b, _ in phases[:40]]
    case = rows.select("i", R.phase_of(F.col("publish_date"), few).alias("phase"))
    assert sorted(map(tuple, R.tag_phases(rows, table.where("rank < 40")).select("i", "phase").collect())) == sorted(map(tuple, case.collect()))
    none = R.tag_phases(rows, table.limit(0))
    assert none.count() == len(times) and none.where("phase is not null").count() == 0
