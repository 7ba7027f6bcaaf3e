"""X1 as a stream: label counts per event-time window, late rows aside.

Spark's own windowed aggregate drops a late row and tells only how many went;
the row itself is lost. Here the job keeps the watermark (the latest event time of
all micro-batches before, less the delay), so a row can be told to be late and put
into a side table. A row counts while its window is open, that is ends after the
watermark, the rule of Spark's aggregate; a window is handed out once, when
the watermark passes its end (append mode).

State between micro-batches is one count per open window and group; sinks have a
folder per micro-batch that a replay overwrites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.streaming.jobs import _run
from pulse.streaming.state import BatchTable, added, batch_folder, run_id


def windowed_counts(source: DataFrame, base: str, checkpoint: str, width: str = "1 hour", delay: str = "1 hour",
                    time_col: str = "publish_date", by: list[str] | None = None, label_col: str = "sentiment",
                    trigger: str | None = "availableNow", processing_time: str | None = None):
    """Count labelled rows per window of ``time_col``, group and label.

    Below ``base``: ``closed`` (final counts, each window once), ``late`` (whole rows that
    came after their window closed or have no time), and the state ``open`` (counts so
    far) and ``watermark``.
    """
    by = by or ["social_media"]
    groups = ["window_start", "window_end", *by, label_col]

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_id(spark, checkpoint)
        batch.persist()
        clock, open_ = BatchTable(spark, f"{base}/watermark"), BatchTable(spark, f"{base}/open")
        before = clock.before(run, batch_id)
        high = before.first()["high"] if before is not None else None
        window = F.window(F.col(time_col), width)
        rows = batch.withColumn("_w", window).withColumn("window_start", F.col("_w.start")).withColumn("window_end", F.col("_w.end")).drop("_w")
        # a row without time has no window: F.window drops it, so it is taken from the batch
        timeless = batch.where(F.col(time_col).isNull())
        # high is an instant held by the driver: one scalar a micro-batch
        passed = F.lit(False) if high is None else F.col("window_end") <= F.lit(high) - F.expr(f"INTERVAL {delay}")
        late = rows.where(passed).drop("window_start", "window_end").unionByName(timeless)
        late.write.mode("overwrite").parquet(batch_folder(f"{base}/late", run, batch_id))
        counts = rows.where(~passed).groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
        latest = batch.agg(F.max(time_col).alias("high"))
        if high is not None:
            latest = latest.select(F.greatest(F.col("high"), F.lit(high)).alias("high"))
        now = clock.write(latest, run, batch_id).first()["high"]
        total = added(open_.before(run, batch_id), counts, groups).persist()
        done = F.lit(False) if now is None else F.col("window_end") <= F.lit(now) - F.expr(f"INTERVAL {delay}")
        total.where(done).write.mode("overwrite").parquet(batch_folder(f"{base}/closed", run, batch_id))
        open_.write(total.where(~done), run, batch_id)
        total.unpersist()
        batch.unpersist()

    writer = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _run(writer, trigger, processing_time)


def read_windows(spark: SparkSession, base: str) -> DataFrame:
    """Counts of all windows with ``status`` closed or open."""
    closed = spark.read.parquet(f"{base}/closed").drop("run", "batch_id").withColumn("status", F.lit("closed"))
    still = BatchTable(spark, f"{base}/open").latest()
    return closed.unionByName(still.withColumn("status", F.lit("open")))


def read_late(spark: SparkSession, base: str) -> DataFrame:
    """Rows that were not counted."""
    return spark.read.parquet(f"{base}/late").drop("run", "batch_id")
