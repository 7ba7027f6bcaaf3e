"""Streaming and round-trip queries of the catalogue.

Each query lands or stages data derived from the driver tables in a fresh
folder below the shared checkpoint root, runs the streaming job to
completion (``availableNow``), replays it from a fresh checkpoint to show
that a replay adds nothing, and returns the sink read back as a batch frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.content import user_or_none, with_defaults
from pulse.operators import filters as FL
from pulse.operators import report as R
from pulse.operators.sentiment import score_comments, score_threads
from pulse.plans import common as CM
from pulse.plans import oracle as O
from pulse.schema import DISCOVERY_PAGE
from pulse.session import materialised, scratch_path
from pulse.sinks.files import stage_documents, stage_keyed, write_parquet, write_report
from pulse.sources import tables as TB
from pulse.sources.files import read_comments, read_threads
from pulse.streaming import jobs as J
from pulse.streaming import labelling as LB
from pulse.streaming import windows as WN

FILES_PER_TRIGGER = DISCOVERY_PAGE
# Landing waves (and micro-batches) of the arrival-order query.
CHUNKS = 5


def _land_threads(spark: SparkSession, sf: str, path: str) -> None:
    stage_documents(CM.threads(spark, sf), path)


def _land_comments(spark: SparkSession, sf: str, path: str) -> None:
    stage_documents(CM.comments(spark, sf), path)


def _label_threads(docs: DataFrame) -> DataFrame:
    return score_threads(with_defaults(docs), CM.scorer())


def _label_comments(docs: DataFrame) -> DataFrame:
    return score_comments(with_defaults(docs), CM.scorer())


def _land_in_order(rows: DataFrame, path: str, chunk: str) -> int:
    """Write JSON wave after wave, so that files arrive in the order of ``chunk``
    (which is not the order of their times); returns the files of a wave."""
    n_files = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for k in range(CHUNKS):
        rows.filter(F.col(chunk) == k).repartition(n_files).write.mode("append").json(path)
    return n_files


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Landed sightings streamed into a keyed store, in several
    micro-batches; later files hold earlier times, and the sighting that arrived
    first is the one that is kept."""
    CM.prepare(spark)
    base = scratch_path(spark, "stream_ingest")
    obs = TB.observations(spark, sf).withColumn("chunk", F.pmod("event_id", F.lit(CHUNKS)))
    files_per_trigger = _land_in_order(obs, f"{base}/landing", "chunk")
    for run in ("first", "replay"):
        src = (spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", files_per_trigger)
               .json(f"{base}/landing"))
        J.ingest_stream(src, f"{base}/store", f"{base}/ledger", f"{base}/ckpt_{run}",
                        ["chunk", "arrival_ts", "event_id"])
    store = spark.read.parquet(f"{base}/store")
    ledger = spark.read.parquet(f"{base}/ledger")
    n_ledger = ledger.select(F.count(F.lit(1))).scalar()
    return store.select("social_media", "scope", "content_id", "event_id", n_ledger.alias("ledger_rows"))


def stream_ingest_stateful(spark: SparkSession, sf: str) -> DataFrame:
    """The seen set in the streaming state store, over several micro-batches
    of which later ones hold earlier times; the query is run, then restarted on the
    same checkpoint (nothing new is emitted)."""
    CM.prepare(spark)
    base = scratch_path(spark, "stream_ingest_state")
    obs = TB.observations(spark, sf).withColumn("chunk", F.pmod("event_id", F.lit(CHUNKS)))
    files_per_trigger = _land_in_order(obs, f"{base}/landing", "chunk")
    for _run in ("first", "restart"):
        src = (spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", files_per_trigger)
               .json(f"{base}/landing"))
        J.ingest_stream_stateful(src, f"{base}/store", f"{base}/ckpt", ["arrival_ts", "event_id"])
    return spark.read.parquet(f"{base}/store").select("social_media", "scope", "content_id", "event_id")


def stream_collect_comments(spark: SparkSession, sf: str,
                            files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Raw comment pages landed as JSON lines, one broken
    page and comments without id or time among them, are parsed and normalised
    inside the stream; rejects go aside with their reason, the others are ingested
    keep-first by (page, position); replayed once from a fresh checkpoint."""
    from pulse.sources.normalize import normalize_comment_pages
    CM.prepare(spark)
    base = scratch_path(spark, "stream_collect")
    TB.faulty_comment_pages(spark, sf).write.json(f"{base}/landing")
    for run in ("first", "replay"):
        pages = (spark.readStream.schema("page long, payload string").option("maxFilesPerTrigger", files_per_trigger)
                 .json(f"{base}/landing"))
        rows = normalize_comment_pages(pages, "payload", TB.OBSERVED_AT, keep=["page"])
        J.ingest_stream(rows, f"{base}/store", f"{base}/ledger", f"{base}/ckpt_{run}", ["page", "position"],
                        rejects=f"{base}/rejects")
    cols = ["content_id", "social_media", "scope", "topic", CM.iso("publish_date").alias("publish_date"),
            F.length("comment_raw_text").alias("n_chars")]
    stored = spark.read.parquet(f"{base}/store").select(*cols, F.lit("stored").alias("status"))
    rejects = spark.read.parquet(f"{base}/rejects").select(*cols, F.col("reason").alias("status"))
    return stored.unionByName(rejects)


def stream_collect_threads(spark: SparkSession, sf: str,
                           files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Landed scrapes (post + fetched comments) are
    turned into thread documents inside the stream and ingested keep-first
    against the ledger; replayed once from a fresh checkpoint."""
    from pulse.sources.normalize import normalize_thread_payload
    CM.prepare(spark)
    base = scratch_path(spark, "stream_threads")
    scrapes = TB.thread_payloads(spark, sf).withColumn("arrival", F.monotonically_increasing_id())
    scrapes.write.json(f"{base}/landing")
    for run in ("first", "replay"):
        raw = (spark.readStream.schema("payload string, arrival long").option("maxFilesPerTrigger", files_per_trigger)
               .json(f"{base}/landing"))
        docs = normalize_thread_payload(raw, "payload", observed_at=TB.OBSERVED_AT, keep=["arrival"])
        J.ingest_stream(docs, f"{base}/store", f"{base}/ledger", f"{base}/ckpt_{run}", ["arrival"],
                        rejects=f"{base}/rejects")
    store = spark.read.parquet(f"{base}/store")
    ids = F.transform("comments", lambda c: c.getField("content_id"))
    return store.select("content_id", "scope", F.size("comments").alias("n_comments"),
                        F.array_join(ids, ",").alias("comment_ids"),
                        F.length("comment_raw_text").alias("n_chars"))


def stream_label(spark: SparkSession, sf: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Staged threads labelled by a streaming query into an
    idempotent store; replayed once from a fresh checkpoint."""
    CM.prepare(spark)
    base = scratch_path(spark, "stream_label")
    _land_threads(spark, sf, f"{base}/staged")
    for run in ("first", "replay"):
        src = read_threads(spark, f"{base}/staged", streaming=True,
                           max_files_per_trigger=files_per_trigger)
        J.label_stream(src, _label_threads, f"{base}/store", f"{base}/rejects", f"{base}/ckpt_{run}")
    out = spark.read.parquet(f"{base}/store")
    return out.select("content_id", "score", "ordinal", "sentiment", "defaulted",
                      F.length("thread_text").alias("n_chars"))


def stream_label_counts(spark: SparkSession, sf: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Running label counts per platform over both staged streams."""
    CM.prepare(spark)
    base = scratch_path(spark, "stream_counts")
    _land_threads(spark, sf, f"{base}/threads")
    _land_comments(spark, sf, f"{base}/comments")
    t = read_threads(spark, f"{base}/threads", streaming=True, max_files_per_trigger=files_per_trigger)
    c = read_comments(spark, f"{base}/comments", streaming=True, max_files_per_trigger=files_per_trigger)
    t_ok, _ = FL.quarantine(t)
    c_ok, _ = FL.quarantine(c)
    cols = ["content_id", "social_media", "sentiment"]
    labelled = _label_threads(t_ok).select(*cols).unionByName(_label_comments(c_ok).select(*cols))
    J.running_label_counts(labelled, f"{base}/counts", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/counts").select("social_media", "sentiment", "n")


def stream_final_report(spark: SparkSession, sf: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Threads and comments staged into one folder, routed by
    platform and labelled by one streaming query; the final report is built
    from everything in the labelled store."""
    CM.prepare(spark)
    base = scratch_path(spark, "stream_report")
    _land_threads(spark, sf, f"{base}/staged")
    _land_comments(spark, sf, f"{base}/staged")
    src = read_threads(spark, f"{base}/staged", streaming=True, max_files_per_trigger=files_per_trigger)
    J.label_stream(src, lambda ok: J.route_and_label(ok, _label_threads, _label_comments),
                   f"{base}/store", f"{base}/rejects", f"{base}/ckpt")
    J.final_report(spark, f"{base}/store", f"{base}/report")
    return _report_rows(spark, f"{base}/report")


def _report_rows(spark: SparkSession, path: str) -> DataFrame:
    """All report tables read back, as rows of (social_media, part, item, value)."""
    def rows(table: str, item, value) -> DataFrame:
        return spark.read.parquet(f"{path}/{table}").select(
            "social_media", F.lit(table).alias("part"), item.alias("item"), value.cast("string").alias("value"))

    slash = lambda *c: F.concat_ws("/", *c)
    parts = [rows("label_share", F.col("sentiment"), F.col("n")),
             rows("item_series", F.col("item_label"), slash("content_id", "sentiment", "colour")),
             rows("texts_by_label", F.col("sentiment"), slash(F.col("n_items").cast("string"), F.col("text_chars").cast("string"))),
             rows("terms_by_label", slash("sentiment", "term"), F.col("n")),
             rows("collocations_by_label", slash("sentiment", "w1", "w2"), F.col("c12")),
             rows("dominant_least", F.col("dominant"), F.col("least")),
             rows("insights", F.col("absent"), F.col("both_extremes")),
             rows("summary", F.lit("summary"), F.col("summary"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_staged_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Staged JSON documents with one broken line per
    folder, read with declared schemas; accepted documents written as
    Parquet partitioned by platform and read back, rejects tagged."""
    CM.prepare(spark)
    base = scratch_path(spark, "staged_docs")
    _land_threads(spark, sf, f"{base}/threads")
    _land_comments(spark, sf, f"{base}/comments")
    broken = spark.range(1).select(F.lit('{"content_id": "broken", "comments": [').alias("value"))
    broken.write.mode("append").text(f"{base}/threads")
    broken.write.mode("append").text(f"{base}/comments")
    out = []
    for kind, reader in (("thread", read_threads), ("comment", read_comments)):
        docs = reader(spark, f"{base}/{kind}s")
        tagged = docs.withColumn("reason", FL.quarantine_reason(docs))
        ok = with_defaults(tagged.filter(F.col("reason").isNull()))
        n_comments = F.size("comments") if kind == "thread" else F.lit(0)
        write_parquet(ok.select("content_id", "social_media", "topic", n_comments.alias("n_comments")),
                      f"{base}/accepted_{kind}", ["social_media"])
        rej = with_defaults(tagged.filter(F.col("reason").isNotNull()))
        out.append(rej.select("content_id", "social_media", F.lit(0).alias("n_comments"),
                              F.col("reason").alias("status")))
    accepted = spark.read.parquet(f"{base}/accepted_thread").unionByName(
        spark.read.parquet(f"{base}/accepted_comment"))
    acc = accepted.select("content_id", "social_media", "n_comments", F.lit("ok").alias("status"))
    result = acc
    for r in out:
        result = result.unionByName(r)
    return result.select("content_id", "social_media", F.col("n_comments").cast("int").alias("n_comments"),
                         "status")


def report_tables(spark: SparkSession, sf: str) -> DataFrame:
    """K6: report tables written per platform, all of them read back (one
    platform's folder at a time, through a partition filter)."""
    CM.prepare(spark)
    base = scratch_path(spark, "report")
    # the tables need these columns alone: scored once, read by each of them
    lab = materialised(CM.labelled(spark, sf).select("social_media", "sentiment"), "report_labels")
    write_report({"label_share": R.label_share(lab), "label_counts": R.label_counts(lab),
                  "summary": R.render_summary(lab)}, base)
    shares = spark.read.parquet(f"{base}/label_share")
    yt = shares.filter(F.col("social_media") == "YouTube")
    rd = shares.filter(F.col("social_media") == "Reddit")
    counts = spark.read.parquet(f"{base}/label_counts").select("social_media", "sentiment", F.col("n").alias("counted"))
    summary = spark.read.parquet(f"{base}/summary")
    return (yt.unionByName(rd).join(counts, ["social_media", "sentiment"]).join(summary, "social_media")
            .select("social_media", "sentiment", "n", "share", "counted", "summary"))


def consumed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Staged comments are labelled, the committed files are moved to
    an archive, and a second run finds nothing new; the author column shows
    deleted authors as text."""
    CM.prepare(spark)
    base = scratch_path(spark, "consumed")
    rows = CM.comments(spark, sf).withColumn("user", F.when(F.length("comment_raw_text") % 3 != 0, F.col("user")))
    stage_documents(rows, f"{base}/staged")
    for _run in ("first", "again"):
        src = read_comments(spark, f"{base}/staged", streaming=True, max_files_per_trigger=2,
                            clean_source="archive", archive_dir=f"{base}/archive")
        J.label_stream(src, _label_comments, f"{base}/store", f"{base}/rejects", f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/store")
    return out.select("content_id", "sentiment", user_or_none("user").alias("author"), F.col("labelled_at").isNotNull().alias("stamped"))


def stream_cycle_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """What each micro-batch of an ingest landed and stored, per platform and
    scope, summed over the batches; ``batches`` counts those that landed any."""
    CM.prepare(spark)
    base = scratch_path(spark, "stream_metrics")
    obs = TB.observations(spark, sf).withColumn("chunk", F.pmod("event_id", F.lit(CHUNKS)))
    per_wave = _land_in_order(obs, f"{base}/landing", "chunk")
    src = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", per_wave).json(f"{base}/landing")
    J.ingest_stream(src, f"{base}/store", f"{base}/ledger", f"{base}/ckpt", ["chunk", "arrival_ts", "event_id"], metrics=f"{base}/metrics")
    per_batch = spark.read.parquet(f"{base}/metrics")
    return per_batch.groupBy("social_media", "scope").agg(F.sum("n_items").alias("n_items"), F.sum("n_new").alias("n_new"),
                                                          F.count(F.lit(1)).alias("batches"))


def _changed(rows: DataFrame) -> DataFrame:
    """Stand-in for edited comments: an abusive word is added."""
    return rows.withColumn("comment_raw_text", F.concat("comment_raw_text", F.lit(" trash trash")))


def stream_label_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """Comments staged twice before the first cycle (the last staging
    counts), some without a time; before the second cycle some of these come again with
    it, and labelled ones come again changed (which changes nothing). Two cycles, then
    all of it again from a fresh checkpoint. Returns stored documents with their number
    in the order of labelling, waiting rejects with their attempts, and the counts per label."""
    CM.prepare(spark)
    base = scratch_path(spark, "label_cycles")
    number = F.substring_index("content_id", "_", -1).cast("long")
    rows = CM.comments(spark, sf)
    broken = rows.withColumn("publish_date", F.when(number % 4 != 0, F.col("publish_date")))

    def cycle(checkpoint: str) -> None:
        src = read_comments(spark, f"{base}/staged", streaming=True, sequence=True)
        LB.label_cycles(src, _label_comments, f"{base}/out", f"{base}/{checkpoint}")

    stage_keyed(broken, f"{base}/staged", position=number)
    stage_keyed(_changed(broken.filter(number % 5 == 0)), f"{base}/staged", position=-number)
    cycle("ckpt")
    stage_keyed(rows.filter((number % 8 == 0) & (number % 5 != 0)), f"{base}/staged", position=number)
    stage_keyed(_changed(rows.filter(number % 4 == 1)), f"{base}/staged", position=number)
    cycle("ckpt")
    cycle("fresh")
    stored = spark.read.parquet(f"{base}/out/store").select(
        F.lit("stored").alias("kind"), "content_id", F.concat_ws("/", "sentiment", F.length("comment_raw_text").cast("string")).alias("detail"), F.col("item").alias("n"))
    waiting = LB.waiting_rejects(spark, f"{base}/out").select(
        F.lit("waiting").alias("kind"), "content_id", F.col("reason").alias("detail"), F.col("attempts").cast("long").alias("n"))
    totals = LB.label_totals(spark, f"{base}/out").select(
        F.lit("total").alias("kind"), F.col("social_media").alias("content_id"), F.col("sentiment").alias("detail"), "n")
    return stored.unionByName(waiting).unionByName(totals)


def stream_sentiment_over_time(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled comments landed in five waves, some of them one or three waves
    after their time, counted per hour, topic and label as a stream with a watermark
    of two hours; late ones are counted aside. The job is run again on its checkpoint."""
    CM.prepare(spark)
    base = scratch_path(spark, "stream_windows")
    number = F.substring_index("content_id", "_", -1).cast("long")
    rows = CM.labelled_comments(spark, sf).select("content_id", "social_media", "topic", "sentiment", "publish_date", number.alias("number"))
    many = rows.agg((F.max("number") + 1).alias("many")).first()["many"]
    late = F.when(F.col("number") % 31 == 0, 3).when(F.col("number") % 7 == 0, 1).otherwise(0)
    waves = rows.withColumn("wave", F.least(F.floor(F.col("number") * CHUNKS / F.lit(many)) + late, F.lit(CHUNKS - 1))).drop("number")
    waves = materialised(waves, "waves")   # scored once, not for every wave
    per_wave = _land_in_order(waves, f"{base}/landing", "wave")
    for _run in ("first", "restart"):
        src = spark.readStream.schema(waves.schema).option("maxFilesPerTrigger", per_wave).json(f"{base}/landing")
        WN.windowed_counts(src, base, f"{base}/ckpt", "1 hour", "2 hours", by=["topic"])
    counted = WN.read_windows(spark, base)
    late_rows = WN.read_late(spark, base).groupBy(F.window("publish_date", "1 hour").alias("w"), "topic", "sentiment").agg(F.count(F.lit(1)).alias("n"))
    late_rows = late_rows.select(F.col("w.start").alias("window_start"), "topic", "sentiment", "n", F.lit("late").alias("status"))
    out = counted.drop("window_end").unionByName(late_rows)
    return out.select(CM.iso("window_start").alias("window_start"), "topic", "sentiment", "n", "status")


STREAM_QUERIES = {
    "stream_ingest": stream_ingest,
    "stream_ingest_stateful": stream_ingest_stateful,
    "stream_collect_comments": stream_collect_comments,
    "stream_collect_threads": stream_collect_threads,
    "stream_label": stream_label,
    "stream_label_counts": stream_label_counts,
    "stream_final_report": stream_final_report,
    "read_staged_documents": read_staged_documents,
    "report_tables": report_tables,
    "consumed_files": consumed_files,
    "stream_cycle_metrics": stream_cycle_metrics,
    "stream_label_cycles": stream_label_cycles,
    "stream_sentiment_over_time": stream_sentiment_over_time,
}

_EDITED = "CASE WHEN doc_id % 5 = 0 THEN text || ' trash trash' ELSE text END"

STREAM_SQL = {
    "stream_ingest": f"""
SELECT 'events' AS social_media, event_type AS scope, 'item_' || user_id AS content_id, event_id,
       (SELECT count(*) FROM (SELECT DISTINCT event_type, user_id FROM events)) AS ledger_rows
FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id % {CHUNKS}, ts, event_id) = 1
""",
    "stream_ingest_stateful": f"""
SELECT 'events' AS social_media, event_type AS scope, 'item_' || user_id AS content_id, event_id
FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id % {CHUNKS}, ts, event_id) = 1
""",
    "stream_collect_comments": f"""
WITH c AS (SELECT *, CASE WHEN n_chars % 11 = 0 THEN 'missing_id' WHEN n_chars % 13 = 0 THEN 'bad_time'
                          WHEN NOT {O.HAS(O.P7('text'))} THEN 'blank_text' ELSE 'stored' END AS status FROM documents)
SELECT CASE WHEN status <> 'missing_id' THEN 'yt_comm_' || doc_id END AS content_id, 'YouTube' AS social_media, source AS scope, lang AS topic,
       CASE WHEN n_chars % 13 <> 0 THEN {O.ISO(O.TS(f'{TB.ORIGIN_EPOCH} + doc_id * {TB.COMMENT_SPACING_S}'))} END AS publish_date,
       CAST(length({O.P7('text')}) AS INTEGER) AS n_chars, status
FROM c
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'malformed'
""",
    "stream_collect_threads": f"""
WITH {O.THREAD_CTES.strip()}
SELECT 'reddit_post_' || tp.conv_id AS content_id, tp.scope,
       CAST((SELECT count(*) FROM tc WHERE tc.conv_id = tp.conv_id) AS INTEGER) AS n_comments,
       coalesce((SELECT string_agg('reddit_comm_' || conv_id || '_' || turn, ',' ORDER BY turn) FROM tc
                 WHERE tc.conv_id = tp.conv_id), '') AS comment_ids,
       CAST(length({O.P6('tp.text')}) AS INTEGER) AS n_chars
FROM tp
""",
    "stream_label": O.SQL["thread_sentiment"],
    "stream_label_counts": O.SQL["label_counts"],
    "stream_final_report": " UNION ALL ".join(
        f"SELECT social_media, '{part}' AS part, {item} AS item, CAST({value} AS VARCHAR) AS value FROM ({O.SQL[name]})"
        for part, name, item, value in [
            ("label_share", "label_share", "sentiment", "n"),
            ("item_series", "item_series", "item_label", "content_id || '/' || sentiment || '/' || colour"),
            ("texts_by_label", "texts_by_label", "sentiment", "n_items || '/' || text_chars"),
            ("terms_by_label", "terms_by_label", "sentiment || '/' || term", "n"),
            ("collocations_by_label", "collocations_by_label", "sentiment || '/' || w1 || '/' || w2", "c12"),
            ("dominant_least", "dominant_least", "dominant", "least"),
            ("insights", "distribution_insights", "absent", "both_extremes"),
            ("summary", "summary_text", "'summary'", "summary")]),
    "read_staged_documents": f"""
WITH p AS (SELECT conv_id, count(*) FILTER (WHERE turn > 0) AS k FROM conversations GROUP BY conv_id
           HAVING count(*) FILTER (WHERE turn = 0) > 0)
SELECT 'reddit_post_' || conv_id AS content_id, 'Reddit' AS social_media,
       CAST(k AS INTEGER) AS n_comments, 'ok' AS status FROM p
UNION ALL
SELECT 'yt_comm_' || doc_id, 'YouTube', 0, 'ok' FROM documents
UNION ALL
SELECT 'Unknown ID', 'Unknown', 0, 'malformed'
UNION ALL
SELECT 'Unknown ID', 'Unknown', 0, 'malformed'
""",
    "report_tables": """
WITH x AS (""" + O.SQL["label_share"] + """), y AS (""" + O.SQL["summary_text"] + """)
SELECT social_media, sentiment, n, share, n AS counted, summary FROM x JOIN y USING (social_media)
""",
    "consumed_files": """
WITH x AS (""" + O.SQL["comment_sentiment"] + f""")
SELECT content_id, sentiment, CASE WHEN length({O.P7('text')}) % 3 <> 0 THEN source ELSE 'None' END AS author, true AS stamped
FROM x JOIN documents ON content_id = 'yt_comm_' || doc_id WHERE NOT defaulted
""",
    "stream_cycle_metrics": f"""
SELECT 'events' AS social_media, event_type AS scope, count(*) AS n_items, count(DISTINCT user_id) AS n_new, count(DISTINCT event_id % {CHUNKS}) AS batches
FROM events GROUP BY event_type
""",
    # cycle 1 labels what has a time; the edited ones were staged after all others, last first
    "stream_label_cycles": f"""
WITH x AS (WITH documents AS (SELECT doc_id, {_EDITED} AS text, lang, source, n_chars FROM documents) SELECT * FROM (""" + O.SQL["comment_sentiment"] + f""")),
d AS (SELECT doc_id, {O.P7(_EDITED)} AS raw, {_EDITED} AS text,
        CASE WHEN doc_id % 4 <> 0 THEN 1 WHEN doc_id % 8 = 0 AND doc_id % 5 <> 0 THEN 2 ELSE 0 END AS cycle FROM documents),
e AS (SELECT d.*, x.sentiment FROM d JOIN x ON x.content_id = 'yt_comm_' || d.doc_id WHERE NOT x.defaulted AND cycle > 0),
b AS (SELECT doc_id, {O.HAS(O.P7('text'))} AS has_text, cycle FROM d)
SELECT 'stored' AS kind, 'yt_comm_' || doc_id AS content_id, sentiment || '/' || length(raw) AS detail,
       row_number() OVER (ORDER BY cycle, CASE WHEN cycle = 1 AND doc_id % 5 = 0 THEN 2 ELSE 1 END, CASE WHEN cycle = 1 AND doc_id % 5 = 0 THEN -doc_id ELSE doc_id END) AS n FROM e
UNION ALL SELECT 'waiting', 'yt_comm_' || doc_id, CASE WHEN cycle = 0 THEN 'bad_time' ELSE 'blank_text' END, 3 FROM b WHERE cycle = 0 OR NOT has_text
UNION ALL SELECT 'total', 'YouTube', sentiment, count(*) FROM e GROUP BY sentiment
""",
    "stream_sentiment_over_time": f"""
WITH x AS (""" + O.SQL["comment_sentiment"] + f"""),
r AS (SELECT d.lang AS topic, x.sentiment, {O.TS(f'{TB.ORIGIN_EPOCH} + doc_id * {TB.COMMENT_SPACING_S}')} AS ts,
  least(CAST(floor(doc_id * {CHUNKS} / (SELECT max(doc_id) + 1 FROM documents)) AS BIGINT) + CASE WHEN doc_id % 31 = 0 THEN 3 WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END, {CHUNKS - 1}) AS wave
  FROM documents d JOIN x ON x.content_id = 'yt_comm_' || d.doc_id),
w AS (SELECT *, date_trunc('hour', ts) AS hour, (SELECT max(ts) - INTERVAL 2 HOUR FROM r b WHERE b.wave < r.wave) AS mark FROM r),
s AS (SELECT *, coalesce(hour + INTERVAL 1 HOUR <= mark, false) AS late FROM w)
SELECT {O.ISO('hour')} AS window_start, topic, sentiment, count(*) AS n,
  CASE WHEN late THEN 'late' WHEN hour + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM r) THEN 'closed' ELSE 'open' END AS status
FROM s GROUP BY hour, topic, sentiment, late
""",
}
