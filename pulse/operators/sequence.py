"""Global 1..n numbering per group without a single-task window.

``row_number() over (partition by platform order by arrival)`` would pull
every row of a platform into one task. Instead the rows are range-partitioned
and sorted on (group, order); each task numbers its own rows; a tiny table of
per-(task, group) counts gives every task its starting offset. The tagged
rows are checkpointed to the shared checkpoint folder so that the ids the
counts were taken from are exactly the ids that get the offsets, even if an
executor is lost and a partition is recomputed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.session import checkpoint_root

ROWS_PER_TASK = 1_000_000


def number_rows(df: DataFrame, group_cols: list[str], order_cols: list[str],
                name: str = "item", num_partitions: int | None = None) -> DataFrame:
    """Adds ``name`` = 1-based position of each row within its group, in
    ``order_cols`` order (which must be total within a group)."""
    spark = df.sparkSession
    checkpoint_root(spark)
    keys = [*group_cols, *order_cols]
    # Materialise the (narrow) input once: the range partitioner samples it
    # and the sort reads it, and neither should recompute its lineage.
    src = df.checkpoint(eager=True)
    if num_partitions:
        n = num_partitions
    else:
        # about ROWS_PER_TASK rows per range, at most the shuffle width
        # (counting the checkpointed input is a cheap read)
        cap = int(spark.conf.get("spark.sql.shuffle.partitions"))
        n = max(1, min(cap, math.ceil(src.count() / ROWS_PER_TASK)))
    ranged = src.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    tagged = (ranged.withColumn("_task", F.spark_partition_id())
              .withColumn("_rid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = tagged.groupBy("_task", *group_cols).agg(F.count(F.lit(1)).alias("_cnt"),
                                                      F.min("_rid").alias("_rid0"))
    before = Window.partitionBy(*group_cols).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    numbered = tagged.join(offsets.select("_task", *group_cols, "_off", "_rid0"),
                           ["_task", *group_cols])
    return (numbered.withColumn(name, (F.col("_off") + F.col("_rid") - F.col("_rid0") + 1).cast("bigint"))
            .drop("_task", "_rid", "_rid0", "_off"))
