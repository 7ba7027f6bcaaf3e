"""Content-record expressions: ids, urls, constant columns, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.schema import (COMMENT_STRUCT, CONTENT, DEFAULT_CONTENT_ID, DEFAULT_PLATFORM,
                          REDDIT_SITE, YOUTUBE_WATCH)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def content_id(prefix: str, native_id) -> Column:
    """platform/kind prefix + native id."""
    return F.concat(F.lit(prefix), _c(native_id).cast("string"))


def reddit_url(permalink) -> Column:
    """Site prefix + permalink."""
    return F.concat(F.lit(REDDIT_SITE), _c(permalink))


def youtube_url(video_id) -> Column:
    """Watch url of a video."""
    return F.concat(F.lit(YOUTUBE_WATCH), _c(video_id))


def constant_columns(platform: str, content_type: str) -> dict[str, Column]:
    """P10: columns the platforms never fill: null locations, zero counts."""
    return {
        "user_location": F.lit(None).cast("string"),
        "social_media": F.lit(platform),
        "geo_location": F.lit(None).cast("string"),
        "repost_count": F.lit(0).cast("bigint"),
        "quote_count": F.lit(0).cast("bigint"),
        "bookmark_count": F.lit(0).cast("bigint"),
        "content_type": F.lit(content_type),
    }


def user_or_none(col) -> Column:
    """Deleted authors rendered as the text ``None`` (on request)."""
    return F.coalesce(_c(col).cast("string"), F.lit("None"))


def with_defaults(df: DataFrame, thread: bool = False) -> DataFrame:
    """Absent or null keys take the documented defaults.

    id -> ``Unknown ID``, platform -> ``Unknown``, text -> ``''``, and a null
    or absent comment list -> empty array. Missing columns are added first so
    a document that lacks a key behaves like one holding null.
    """
    for field in CONTENT.fields:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    df = (df.withColumn("content_id", F.coalesce("content_id", F.lit(DEFAULT_CONTENT_ID)))
            .withColumn("social_media", F.coalesce("social_media", F.lit(DEFAULT_PLATFORM)))
            .withColumn("comment_raw_text", F.coalesce("comment_raw_text", F.lit(""))))
    if thread or "comments" in df.columns:
        empty = F.array().cast(f"array<{COMMENT_STRUCT.simpleString()}>")
        if "comments" not in df.columns:
            df = df.withColumn("comments", empty)
        df = df.withColumn("comments", F.coalesce("comments", empty))
    return df
