"""Seen-ledger membership and keep-first deduplication.

Keep-first is an aggregate, not a window: ``min_by(row, order)`` per key is a
declarative aggregate with a partial (map-side) phase, so a key that holds a
third of all rows is reduced to one row per map task before the shuffle.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

LEDGER_KEYS = ["social_media", "scope", "content_id"]

#: bitmaps (4 KB each) that ``marked`` sends to every task; a prime, so that the numbers of many tasks spread over them
BITMAPS = 4093


def keep_first(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the first in ``order_cols`` (make the order total).

    An order made of key columns only is the same for all rows of a key and is
    refused. Output columns keep the input order.
    """
    if set(order_cols) <= set(keys):
        raise ValueError(f"{order_cols} cannot tell the rows of {keys} apart: add an arrival column")
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.dropDuplicates(keys)
    first = F.min_by(F.struct(*payload), F.struct(*[F.col(c) for c in order_cols]))
    agg = df.groupBy(*keys).agg(first.alias("_first"))
    return agg.select(*keys, "_first.*").select(*df.columns)


def dedup_first(df: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """Within-batch dedup, first arrival wins."""
    keys = [key] if isinstance(key, str) else list(key)
    return keep_first(df, keys, order_cols)


def dedup_if_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """As D2, but a frame without the key column is returned unchanged
    (with a warning), as the dataset writer did."""
    if key not in df.columns:
        log.warning("column %r does not exist, unable to remove duplicates", key)
        return df
    return dedup_first(df, key, order_cols)


def union_keep_first(existing: DataFrame | None, new: DataFrame, key: str | list[str],
                     order_cols: list[str]) -> DataFrame:
    """D3 / K1: existing + new, the first observation of a key wins.

    Rows already stored always beat new ones (batch priority), then the
    arrival order decides inside a batch; a later sighting never updates the
    stored counts. Columns missing on one side are null-filled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    tagged_new = new.withColumn("_batch", F.lit(1))
    if existing is None:
        both = tagged_new
    else:
        both = existing.withColumn("_batch", F.lit(0)).unionByName(tagged_new, allowMissingColumns=True)
    return keep_first(both, keys, ["_batch", *order_cols]).drop("_batch")


def skip_seen(df: DataFrame, ledger: DataFrame | None, keys: list[str] | None = None) -> DataFrame:
    """Drop items whose (platform, scope, id) is in the ledger.

    Membership is scoped: an id seen in one scope is new in another. No
    ledger -> everything is new. The join is a plain left-anti join: the
    ledger grows with history, so no size is assumed - AQE turns it into a
    broadcast at run time when the ledger stage is small, and splits skewed
    partitions of the probe side otherwise.
    """
    keys = keys or LEDGER_KEYS
    if ledger is None:
        return df
    # null-safe: a null key part matches its recorded copy (still an equi-join)
    known = ledger.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    return df.join(known, [df[k].eqNullSafe(known[f"_seen_{k}"]) for k in keys], "left_anti")


def ledger_entries(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """K4: the (platform, scope, id) entries a processed frame adds."""
    keys = keys or LEDGER_KEYS
    return df.select(*keys).dropDuplicates(keys)


def marked(rows: DataFrame, some: DataFrame, number: str) -> DataFrame:
    """``rows`` whose ``number`` (as of ``monotonically_increasing_id``) is one of ``some``.

    One bit a number is broadcast, so no row is shuffled. Rows of so many tasks or so
    long ones that two of their blocks share a bitmap can pass in excess (never be
    missed): join the result with ``some`` on the number where that counts.
    """
    bucket, bit = F.pmod(F.bitmap_bucket_number(number), F.lit(BITMAPS)), F.bitmap_bit_position(number)
    bits = some.where(F.col(number).isNotNull()).select(bucket.alias("_bucket"), bit.alias("_bit"))
    bits = bits.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(bits), bucket == F.col("_bucket"))
    return found.where(F.getbit(byte, (bit % 8).cast("int")) == 1).drop("_bucket", "_bits")
