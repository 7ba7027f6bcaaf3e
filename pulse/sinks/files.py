"""K1 (write), K2, K3, K6: dataset, staging, labelled store, report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.text import emoji_csv
from pulse.schema import CORRUPT_COLUMN, STAGED_ORDER
from pulse.sources import folders
from pulse.sources.files import CSV_OPTIONS


def to_csv_columns(df: DataFrame) -> DataFrame:
    """Arrays become comma-joined cells for the CSV dataset."""
    out = df
    for name, dtype in df.dtypes:
        if dtype.startswith("array"):
            out = out.withColumn(name, emoji_csv(F.col(name)))
    return out


def write_topic(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K1 (write side): write a dataset version as CSV with a header.

    Always a *new* path: a version is never written over the input it was
    computed from (the merge reads the previous version).
    """
    writer = to_csv_columns(df).write.mode("errorifexists").options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "errorifexists") -> None:
    """The same dataset as Parquet, optionally partitioned (e.g. by
    ``social_media``, ``topic`` - filters on them prune directories)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def stage_documents(df: DataFrame, path: str, packed: bool = False) -> None:
    """K2: one JSON document per thread / comment, appended to the landing
    folder. The labelling jobs keep one document per id, so staging an id again
    (e.g. after a crash between staging and the ledger) changes no result.
    ``packed``: as gzip, which readers of the folder unpack by themselves."""
    writer = df.write.mode("append")
    if packed:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.json(path)


def stage_keyed(df: DataFrame, path: str, position: Column | None = None) -> int:
    """K2, keyed: stage documents with the number of this staging and their position.

    The number is claimed by a marker file (one winner each), so it grows with
    every staging; ``position`` orders the documents of one staging (the order
    of the frame by default). Readers take the last staged document of an id.
    """
    spark = df.sparkSession
    taken = [int(n) for n in folders.names(spark, f"{path}/_seq")]
    seq = max(taken, default=0) + 1
    while not folders.claim(spark, f"{path}/_seq/{seq}"):
        seq += 1
    at = F.monotonically_increasing_id() if position is None else position.cast("long")
    stage_documents(df.withColumn(STAGED_ORDER[0], F.lit(seq).cast("long")).withColumn(STAGED_ORDER[1], at), path, packed=True)
    return seq


def staged_identity(docs: DataFrame, key: str = "content_id") -> Column:
    """What tells staged documents apart: the key, else the raw text of a line that
    could not be read, else the content."""
    raw = F.col(CORRUPT_COLUMN) if CORRUPT_COLUMN in docs.columns else F.lit(None)
    content = F.to_json(F.struct(*[F.col(c) for c in docs.columns if c not in STAGED_ORDER]))
    return F.coalesce(F.col(key), raw, content)


def latest_staged(docs: DataFrame, key: str = "content_id", content_hash: str | None = None) -> DataFrame:
    """K2, read side: the last staged document of each id, with its identity ``_row``.

    An aggregate with a partial phase. Documents staged without order come before
    all others; what the order does not decide, a hash of the content does
    (``content_hash``: the column with it, in frames without the content).
    """
    for c in STAGED_ORDER:
        if c not in docs.columns:
            docs = docs.withColumn(c, F.lit(None).cast("long"))
    plain = [c for c in docs.columns if c not in STAGED_ORDER]
    order = F.struct(*STAGED_ORDER, F.col(content_hash) if content_hash else F.xxhash64(*plain))
    last = F.max_by(F.struct(*docs.columns), order)
    return docs.withColumn("_row", staged_identity(docs, key)).groupBy("_row").agg(last.alias("_last")).select("_row", "_last.*")


def write_report(tables: dict[str, DataFrame], path: str, partition_by: str = "social_media") -> None:
    """K6: report tables as Parquet, one folder per table, per platform."""
    for name, table in tables.items():
        table.write.mode("overwrite").partitionBy(partition_by).parquet(f"{path}/{name}")
