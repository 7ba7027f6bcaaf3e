"""State that a streaming job keeps between micro-batches, as small tables.

A version is the state after one micro-batch of one run (the query id that the
checkpoint holds). A micro-batch computes its version from the one before its own,
so a replay reads what the first attempt read and overwrites what it wrote.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.sources import folders

#: versions that are kept; a replay needs the last two
KEPT = 3


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The query id that a checkpoint keeps over restarts."""
    return json.loads(folders.first_line(spark, f"{checkpoint}/metadata"))["id"]


def batch_folder(base: str, run: str, batch_id: int) -> str:
    """Where a micro-batch puts its rows of a sink; it overwrites the folder."""
    return f"{base}/run={run}/batch_id={batch_id}"


class BatchTable:
    """A table with a version per micro-batch, at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _versions(self) -> list[str]:
        return [n for n in folders.names(self.spark, self.path) if n.startswith("v") and
                folders.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]

    def _own(self, run: str, batch_id: int) -> str | None:
        tail = f"-{run}.{batch_id}"
        return next((n for n in folders.names(self.spark, self.path) if n.endswith(tail)), None)

    def before(self, run: str, batch_id: int) -> DataFrame | None:
        """The state that this micro-batch starts from; None at the very first."""
        own = self._own(run, batch_id)
        made = [n for n in self._versions() if own is None or n < own]
        return self.spark.read.parquet(f"{self.path}/{made[-1]}") if made else None

    def latest(self) -> DataFrame | None:
        made = self._versions()
        return self.spark.read.parquet(f"{self.path}/{made[-1]}") if made else None

    def write(self, df: DataFrame, run: str, batch_id: int) -> DataFrame:
        """The state after this micro-batch; returns it as written."""
        made = [n for n in folders.names(self.spark, self.path) if n.startswith("v")]
        own = self._own(run, batch_id) or f"v{int(made[-1][1:13]) + 1 if made else 0:012d}-{run}.{batch_id}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{own}")
        for old in [n for n in made if n < own][:-KEPT]:
            folders.delete(self.spark, f"{self.path}/{old}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{own}")


def added(before: DataFrame | None, delta: DataFrame, by: list[str], n: str = "n") -> DataFrame:
    """Counts ``n`` per ``by`` after adding ``delta`` to what was there before."""
    both = delta if before is None else before.select(*by, n).unionByName(delta.select(*by, n))
    return both.groupBy(*by).agg(F.sum(n).alias(n))
