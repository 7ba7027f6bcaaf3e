"""Structured Streaming jobs over landed / staged documents.

* ``ingest_stream`` (W1 W3 W4 K2 K4): landed sightings -> keep-first per key
  inside the micro-batch -> skip keys in the durable ledger -> stage -> record.
* ``label_stream`` (W2 W6 K3 K5): staged documents -> quarantine -> label ->
  idempotent append to the labelled store; rejects go to a side table.
* ``running_label_counts`` (W5): label counts per platform kept as streaming
  state (complete mode), checkpointed so they survive restarts.
* ``dedup_within_watermark`` (W4, bounded form): streaming dedup whose state
  expires with the watermark.
* ``final_report`` (W7): the report tables over the labelled store.

Every sink write is idempotent (anti-join on the key before appending), so a
micro-batch replayed after a failure - or a full replay from a fresh
checkpoint - adds nothing: delivery is at-least-once, the effect exactly-once.
Consumed files are tracked by the checkpoint (K5); ``cleanSource`` can
archive or delete them.
"""

from __future__ import annotations

from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.operators import dedup as D
from pulse.operators import filters as FL
from pulse.operators import report as R
from pulse.operators.ledger import Ledger
from pulse.operators.threads import route_by_platform
from pulse.operators import terms as TR
from pulse.operators.threads import item_texts
from pulse.schema import CORRUPT_COLUMN
from pulse.sinks.files import write_report
from pulse.sources.files import no_data
from pulse.streaming.state import batch_folder, run_id


def read_or_none(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame | None:
    """The Parquet table at ``path`` (only ``columns``), or None if absent."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if not no_data(e):
            raise
        return None
    return df.select(*columns) if columns else df


def append_new(batch: DataFrame, path: str, keys: list[str], order_cols: list[str] | None = None) -> None:
    """Append rows whose key is not yet at ``path`` (idempotent append).

    Of rows with one key in the batch the first in ``order_cols`` is taken.
    """
    spark = batch.sparkSession
    fresh = D.keep_first(batch, keys, order_cols) if order_cols else batch.dropDuplicates(keys)
    existing = read_or_none(spark, path, keys)
    if existing is not None:
        # null-safe key equality: a row with a null key part still matches
        # its stored copy (planned as an equi-join all the same)
        cond = [fresh[k].eqNullSafe(existing[k]) for k in keys]
        fresh = fresh.join(existing, cond, "left_anti")
    fresh.write.mode("append").parquet(path)


def with_identity(docs: DataFrame, key: str = "content_id") -> DataFrame:
    """``docs`` with ``_row``: the key, else the raw text of a line that could
    not be read, else the content - never null, so replays match it."""
    raw = F.col(CORRUPT_COLUMN) if CORRUPT_COLUMN in docs.columns else F.lit(None)
    content = F.to_json(F.struct(*[F.col(c) for c in docs.columns]))
    return docs.withColumn("_row", F.coalesce(F.col(key), raw, content))


def append_rejects(rejected: DataFrame, path: str) -> None:
    """append rejected documents with their reason, each once."""
    append_new(with_identity(rejected), path, ["_row", "reason"])


def _run(writer, trigger: str | None, processing_time: str | None):
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif trigger == "once":
        writer = writer.trigger(once=True)
    else:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    if not processing_time:
        query.awaitTermination()
    return query


def ingest_stream(source: DataFrame, store: str, ledger: str, checkpoint: str,
                  order_cols: list[str], keys: list[str] | None = None,
                  rejects: str | None = None, metrics: str | None = None,
                  trigger: str | None = "availableNow", processing_time: str | None = None):
    """Endless fetch -> dedup -> append, as a streaming query.

    ``source`` is a streaming DataFrame of observations (``readStream`` of
    the landing folder with ``maxFilesPerTrigger`` = W3). Per micro-batch:
    D2 keep-first, D1 against the bucketed ledger, K2 stage, K4 record. The new
    rows of a micro-batch overwrite its own folder of the store, and a replay
    does not see the entries it recorded itself, so a crash between the steps is repaired
    by the replay; a run from a fresh checkpoint finds all keys in the ledger. A trigger
    reads the ledger's buckets of its keys, and never the store.
    ``order_cols`` hold the arrival (and tell rows of one key apart). With
    ``rejects``, rows that fail the quarantine (F7) go there with their reason, each once;
    with ``metrics``, every micro-batch leaves its time and its counts of landed and new
    items per platform and scope there (A12).
    """
    keys = keys or D.LEDGER_KEYS
    # A12 (streaming form): items seen per micro-batch, reported in the
    # query progress (``lastProgress["observedMetrics"]["cycle"]``).
    source = source.observe("cycle", F.count(F.lit(1)).alias("items"),
                            F.approx_count_distinct(F.col(keys[-1])).alias("approx_distinct"))

    def once(rows: DataFrame, pick: Callable[[DataFrame], DataFrame], path: str, seen: Ledger, run: str, batch_id: int) -> None:
        """Of each key that is new one row (``pick``) into the batch's folder, then the
        keys into the ledger. Known keys go first, so a replay picks among nothing."""
        look = seen.lookup(rows, f"{run}/{batch_id}")
        fresh = pick(look.unseen()).persist()
        fresh.write.mode("overwrite").parquet(batch_folder(path, run, batch_id))  # K2
        look.record(fresh)                                                        # K4
        fresh.unpersist()

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_id(spark, checkpoint)
        batch.persist()
        ok = batch
        if rejects:
            ok, rejected = FL.quarantine(batch)
            rejected = with_identity(rejected).withColumn("_key", F.sha2("_row", 256))
            once(rejected, lambda r: r.dropDuplicates(["reason", "_key"]), rejects, Ledger(spark, f"{rejects}_ledger", ["reason", "_key"]), run, batch_id)
        once(ok, lambda r: D.keep_first(r, keys, order_cols), store, Ledger(spark, ledger, keys), run, batch_id)
        if metrics:
            stored = spark.read.schema(ok.schema).parquet(batch_folder(store, run, batch_id))
            both = ok.select(*keys[:-1], F.lit(0).alias("new")).unionByName(stored.select(*keys[:-1], F.lit(1).alias("new")))
            (both.groupBy(*keys[:-1]).agg(F.sum(1 - F.col("new")).alias("n_items"), F.sum("new").alias("n_new"))
             .withColumn("at", F.current_timestamp()).write.mode("overwrite").parquet(batch_folder(metrics, run, batch_id)))
        batch.unpersist()

    writer = (source.writeStream.foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    return _run(writer, trigger, processing_time)


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ingest_stream_stateful(source: DataFrame, store: str, checkpoint: str, order_cols: list[str],
                           keys: list[str] | None = None, use_rocksdb: bool = True,
                           trigger: str | None = "availableNow", processing_time: str | None = None):
    """W1 + W4 with the seen set in the streaming state store: O(batch) work
    per trigger, however long the history, and arrival-ordered keep-first.

    The state keeps, for every key ever seen, its first row by (micro-batch,
    ``order_cols``) and the times of the first and last micro-batch that brought
    it. A trigger hands out the keys it touched; those whose two times are equal
    are new. The sink needs no read: each micro-batch overwrites its own
    ``batch_id=`` folder, so a batch replayed after a failure (with the batch time
    that the checkpoint recorded) replaces itself. The RocksDB provider keeps large
    state off the JVM heap; it is fixed per checkpoint, so it is set only when the
    session has not chosen one.
    """
    keys = keys or D.LEDGER_KEYS
    spark = source.sparkSession
    key = "spark.sql.streaming.stateStore.providerClass"
    payload = [c for c in source.columns if c not in keys]
    seen = source.withColumn("_batch", F.current_timestamp()).groupBy(*keys).agg(
        F.min_by(F.struct(*payload), F.struct("_batch", *order_cols)).alias("_first"),
        F.min("_batch").alias("_from"), F.max("_batch").alias("_to"))

    def each(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.filter("_from = _to").select(*keys, "_first.*")
        fresh.write.mode("overwrite").parquet(f"{store}/batch_id={batch_id}")

    # a query takes the provider at its start; the session keeps its own choice
    unset = use_rocksdb and not spark.conf.get(key, None)
    if unset:
        spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        writer = seen.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
        return _run(writer, trigger, processing_time)
    finally:
        if unset:
            spark.conf.unset(key)


def label_stream(source: DataFrame, label: Callable[[DataFrame], DataFrame], store: str,
                 rejects: str, checkpoint: str, key: str = "content_id",
                 trigger: str | None = "availableNow", processing_time: str | None = None,
                 idempotency: str = "key"):
    """Staged -> quarantine -> label -> store, as a streaming query.

    ``label`` maps accepted documents to labelled rows (e.g. a scorer's
    ``label``); rejected documents go to a side table (F7).

    ``idempotency="key"`` (K3, default): rows whose key is already stored
    are dropped before appending, so even a replay from a fresh checkpoint
    adds nothing (W6); costs a key-only scan of the store per trigger.
    ``idempotency="batch"``: documents are kept once by streaming state (by key,
    or by their text where they have none) and each micro-batch overwrites its
    own ``batch_id=`` folder - O(batch) per trigger; exact as long as restarts
    reuse the checkpoint.
    """
    if idempotency not in ("key", "batch"):
        raise ValueError(f"unknown idempotency {idempotency!r}")
    if idempotency == "batch":
        source = with_identity(source, key).dropDuplicates(["_row"]).drop("_row")

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        ok, rejected = FL.quarantine(batch)
        labelled = label(ok.drop(CORRUPT_COLUMN)).withColumn("labelled_at", F.current_timestamp())  # X3
        if idempotency == "key":
            append_new(labelled, store, [key])
            append_rejects(rejected, rejects)
        else:
            labelled.write.mode("overwrite").parquet(f"{store}/batch_id={batch_id}")
            rejected.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        batch.unpersist()

    writer = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _run(writer, trigger, processing_time)


def running_label_counts(labelled_stream: DataFrame, sink: str, checkpoint: str,
                         trigger: str | None = "availableNow", processing_time: str | None = None):
    """Label counts per platform as checkpointed streaming state.

    A document that arrives again is counted once (its id stays in the state).
    Complete mode: each trigger hands the whole (tiny) count table to the
    batch writer, which replaces the sink's content.
    """
    once = labelled_stream.dropDuplicates(["social_media", "content_id"])
    counts = once.groupBy("social_media", "sentiment").agg(F.count(F.lit(1)).alias("n"))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    writer = (counts.writeStream.outputMode("complete").foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    return _run(writer, trigger, processing_time)


def dedup_within_watermark(source: DataFrame, time_col: str, delay: str,
                           keys: list[str] | None = None) -> DataFrame:
    """W4 (bounded): drop repeats of a key seen within the watermark delay;
    state for a key is dropped once the watermark passes it."""
    keys = keys or D.LEDGER_KEYS
    return source.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def route_and_label(docs: DataFrame, label_threads, label_comments) -> DataFrame:
    """D7 for streams: threads and comments labelled by their own rule; the
    whole documents are kept."""
    threads, comments = route_by_platform(docs)
    return label_threads(threads).unionByName(label_comments(comments), allowMissingColumns=True)


def final_report(spark: SparkSession, store: str, out: str | None = None) -> dict[str, DataFrame]:
    """The report over everything in the labelled store (not only the
    current session), optionally written per platform (K6): label shares, the
    item series, texts, terms and collocations per label, insights, summary."""
    labelled = spark.read.parquet(store)
    shares = R.label_share(labelled)
    texts = labelled.select("social_media", "content_id", "sentiment", F.explode(item_texts(labelled)).alias("text"))
    groups = ["social_media", "sentiment"]
    counted = TR.pair_counts(texts, groups)   # words and pairs of A6 and A7, tokenised once
    tables = {
        "label_share": shares,
        "item_series": R.item_series(labelled, ["publish_date", "content_id"]),
        "texts_by_label": R.texts_by_label(texts),
        "terms_by_label": TR.term_frequency(texts, groups, counted=counted),
        "collocations_by_label": TR.collocations(texts, groups, counted=counted),
        "dominant_least": R.dominant_from_shares(shares),
        "insights": R.insights_from_shares(shares),
        "summary": R.render_summary(labelled),
    }
    if out:
        write_report(tables, out)
    return tables
