"""Row filters and the quarantine split."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.text import has_text
from pulse.schema import CORRUPT_COLUMN, DEFAULT_CONTENT_ID, PLATFORMS

log = logging.getLogger(__name__)

# Quarantine reasons, in the order they are tested.
MALFORMED = "malformed"
EMPTY = "empty"
MISSING_ID = "missing_id"
UNKNOWN_PLATFORM = "unknown_platform"
BAD_TIME = "bad_time"
BLANK_TEXT = "blank_text"


def select_platforms(df: DataFrame, wanted: list[str], col: str = "social_media"):
    """keep the requested platforms that are known.

    Returns ``(frame, rejected_names)``; unknown names are reported, skipped.
    """
    known = [p for p in wanted if p in PLATFORMS]
    rejected = [p for p in wanted if p not in PLATFORMS]
    if rejected:
        log.warning("unknown platforms skipped: %s", ", ".join(rejected))
    return df.filter(F.col(col).isin(known)), rejected


def topic_scope(df: DataFrame, topic: str | None = None, scope: str | None = None) -> DataFrame:
    """restrict to one topic and/or one scope (partition pruning when the
    dataset is partitioned by these columns)."""
    if topic is not None:
        df = df.filter(F.col("topic") == topic)
    if scope is not None:
        df = df.filter(F.col("scope") == scope)
    return df


def known_platform(col: str = "social_media") -> Column:
    """predicate, the platform is one of the two supported."""
    return F.col(col).isin(PLATFORMS)


def drop_blank_comments(comments: Column) -> Column:
    """remove blank comments inside a thread's comment array."""
    return F.filter(comments, lambda c: has_text(c.getField("comment_raw_text")))


def thread_is_blank(post_text: Column, comments: Column) -> Column:
    """Neither the post nor any comment has text."""
    return ~has_text(post_text) & (F.size(drop_blank_comments(comments)) == 0)


def drop_empty_threads(threads: DataFrame) -> DataFrame:
    """drop threads with neither post text nor comment text."""
    return threads.filter(~thread_is_blank(F.col("comment_raw_text"), F.col("comments")))


def quarantine_reason(df: DataFrame) -> Column:
    """one reason per rejected document (null = accepted).

    malformed: the line was not JSON; empty: a document with no field set;
    missing_id: no content id, so it could not be told from others;
    unknown_platform; bad_time: no parseable publish instant; blank_text: no
    text to label (for threads: neither post nor any comment has text).
    """
    data_cols = [c for c in df.columns if c != CORRUPT_COLUMN]
    corrupt = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in df.columns else F.lit(False)
    empty = F.lit(True)
    for c in data_cols:
        if dict(df.dtypes)[c].startswith("array"):
            empty = empty & (F.col(c).isNull() | (F.size(c) == 0))
        else:
            empty = empty & F.col(c).isNull()
    if "comments" in df.columns:
        blank = thread_is_blank(F.col("comment_raw_text"), F.coalesce("comments", F.array()))
    else:
        blank = ~has_text(F.col("comment_raw_text"))
    no_id = F.lit(False)
    if "content_id" in df.columns:
        no_id = F.col("content_id").isNull() | (F.col("content_id") == DEFAULT_CONTENT_ID)
    time_missing = F.col("publish_date").isNull() if "publish_date" in df.columns else F.lit(False)
    return (F.when(corrupt, F.lit(MALFORMED))
            .when(empty, F.lit(EMPTY))
            .when(no_id, F.lit(MISSING_ID))
            .when(~F.coalesce(known_platform(), F.lit(False)), F.lit(UNKNOWN_PLATFORM))
            .when(time_missing, F.lit(BAD_TIME))
            .when(blank, F.lit(BLANK_TEXT)))


def quarantine(df: DataFrame):
    """split into (accepted, rejected); rejected rows carry ``reason``.

    Both halves derive from one tagged frame; callers that use both should
    persist the input (a streaming micro-batch does, in ``foreachBatch``).
    """
    tagged = df.withColumn("reason", quarantine_reason(df))
    ok = tagged.filter(F.col("reason").isNull()).drop("reason")
    rejected = tagged.filter(F.col("reason").isNotNull())
    return ok, rejected
