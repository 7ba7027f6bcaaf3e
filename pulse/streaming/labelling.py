"""Labelling cycles over keyed staging, with a queue of rejects.

A staged document carries the number of the staging (``staged_seq``) and its position in
it, so of several documents with one id the one staged last stands for the id until
it is labelled. What the quarantine rejects waits in a queue and is tried again in
every cycle, or its newer staging in its place; it leaves when it is accepted.
Labelled documents are numbered per platform in the order of labelling,
from the totals of the cycles before, and every cycle writes how many it added per
platform and label, so a report reads numbers and counts instead of making them.

The cost of a cycle is that of its documents and the waiting rejects: ids labelled
before are found in a bucketed ledger, all other state is one row a platform. What a
cycle does with each document is decided on its key, order and reason; texts are read
again where they are written, and only what is written is shuffled whole, once. Everything
a cycle writes has a name of its own and is a function of the state before it, so
a replay overwrites it; a run from a fresh checkpoint finds all ids in the ledger.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.operators import filters as FL
from pulse.operators.dedup import marked
from pulse.operators.ledger import Ledger
from pulse.operators.sequence import number_rows
from pulse.schema import CORRUPT_COLUMN, STAGED_ORDER
from pulse.session import settled
from pulse.sinks.files import latest_staged, staged_identity
from pulse.streaming.jobs import _run
from pulse.streaming.state import BatchTable, added, batch_folder, run_id

_WAITING = ["reason", "attempts", "first_rejected", "last_rejected"]

#: shuffle files go when the query that wrote them ends, not when the driver happens to collect garbage
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def label_cycles(source: DataFrame, label: Callable[[DataFrame], DataFrame], base: str, checkpoint: str,
                 key: str = "content_id", trigger: str | None = "availableNow", processing_time: str | None = None):
    """Label staged documents (``source`` read with their staging order) once per id.

    Below ``base``: ``store`` (labelled documents with ``labelled_at`` and ``item``, the number on
    their platform), ``rejects`` (the queue: document, ``reason``, ``attempts``, first and last
    time), ``counts`` (what each cycle added), ``labelled`` (ledger), ``numbers`` (totals).
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.conf.set(_CLEANUP, "true")   # the stream's own session
        run = run_id(spark, checkpoint)
        by = f"{run}/{batch_id}"
        ledger = Ledger(spark, f"{base}/labelled", ["_id"])
        queue, numbers = BatchTable(spark, f"{base}/rejects"), BatchTable(spark, f"{base}/numbers")
        for c in STAGED_ORDER:
            if c not in batch.columns:
                batch = batch.withColumn(c, F.lit(None).cast("long"))
        plain = [c for c in batch.columns if c not in STAGED_ORDER]
        fresh = ["_row", *batch.columns]
        # numbered as read: the batch is planned once, so each reading of it gives the same numbers
        batch = settled(batch).select(staged_identity(batch, key).alias("_row"), "*", F.monotonically_increasing_id().alias("_at"))
        reason = FL.quarantine_reason(batch.select(*plain))

        def short(docs: DataFrame, *more) -> DataFrame:
            """What is decided on; malformed lines have their whole text as identity, so it holds a digest."""
            return docs.select(F.sha2("_row", 256).alias("_id"), F.when(reason.isNull(), F.col("_row")).alias("_ok"), "social_media",
                               *STAGED_ORDER, F.xxhash64(*plain).alias("_hash"), "_at", reason.alias("reason"), *more)

        staged = short(batch).persist()
        docs = latest_staged(ledger.lookup(staged, by).unseen(), "_id", "_hash").drop("_row")
        waiting = queue.before(run, batch_id)
        if waiting is not None:
            waiting = waiting.withColumn("_at", F.lit(None).cast("long"))
            # a newer staging of a waiting document takes its place and its history
            kept = short(waiting, F.col("attempts").alias("_a"), F.col("first_rejected").alias("_f"))
            again = kept.drop("_a", "_f").join(docs.select("_id"), "_id", "left_anti")
            docs = docs.unionByName(again).join(kept.select("_id", "_a", "_f"), "_id", "left")
        else:
            docs = docs.withColumn("_a", F.lit(None).cast("int")).withColumn("_f", F.lit(None).cast("timestamp"))
        docs = docs.persist()
        look = ledger.lookup(docs, by)
        todo = look.unseen().persist()

        def whole(some: DataFrame, where) -> DataFrame:
            """The documents of ``some``, and waiting ones to be joined with it (``where`` holds for both)."""
            out = marked(batch, some, "_at")
            return out if waiting is None else out.unionByName(waiting.where(where).select(*out.columns))

        ok = todo.where("reason is null")
        number = number_rows(ok.select("_ok", "_at", "social_media", *STAGED_ORDER), ["social_media"], [*STAGED_ORDER, "_ok"], "item")
        number = number.select(F.col("_ok").alias("_r"), F.col("_at").alias("_n_at"), "item")
        labelled = label(whole(ok, reason.isNull()).withColumn("_id", F.sha2("_row", 256)).drop(CORRUPT_COLUMN))
        labelled = labelled.join(number, (labelled["_row"] == number["_r"]) & labelled["_at"].eqNullSafe(number["_n_at"])).drop("_r", "_at", "_n_at")
        totals = numbers.before(run, batch_id)
        if totals is not None:
            totals = totals.select(F.col("social_media").alias("_p"), F.col("n").alias("_n"))
            labelled = labelled.join(F.broadcast(totals), labelled["social_media"] == totals["_p"], "left")   # a row per known platform
            labelled = labelled.withColumn("item", F.col("item") + F.coalesce("_n", F.lit(0))).drop("_p", "_n")
        folder = batch_folder(f"{base}/store", run, batch_id)
        labelled.withColumn("labelled_at", F.current_timestamp()).write.mode("overwrite").option("compression", "zstd").parquet(folder)
        done = spark.read.schema(labelled.schema).parquet(folder)
        gained = done.groupBy("social_media", "sentiment").agg(F.count(F.lit(1)).alias("n"))
        gained.write.mode("overwrite").parquet(batch_folder(f"{base}/counts", run, batch_id))
        numbers.write(added(numbers.before(run, batch_id), gained, ["social_media"]), run, batch_id)
        bad = todo.where("reason is not null")
        past = bad.select(F.col("_id").alias("_r"), F.col("_at").alias("_n_at"), F.col("reason").alias("_why"), "_a", "_f")
        left = whole(bad, reason.isNotNull())
        left = left.join(past, (F.sha2(left["_row"], 256) == past["_r"]) & left["_at"].eqNullSafe(past["_n_at"])).select(
            *fresh, F.col("_why").alias("reason"), (F.coalesce("_a", F.lit(0)) + 1).alias("attempts"),
            F.coalesce("_f", F.current_timestamp()).alias("first_rejected"), F.current_timestamp().alias("last_rejected"))
        queue.write(left, run, batch_id)
        look.record(done)
        for kept_rows in (todo, docs, staged):
            kept_rows.unpersist()

    writer = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _run(writer, trigger, processing_time)


def label_totals(spark: SparkSession, base: str) -> DataFrame:
    """Documents per platform and label, summed from what each cycle added."""
    return spark.read.parquet(f"{base}/counts").groupBy("social_media", "sentiment").agg(F.sum("n").alias("n"))


def waiting_rejects(spark: SparkSession, base: str) -> DataFrame | None:
    """documents that wait for another try."""
    return BatchTable(spark, f"{base}/rejects").latest()
