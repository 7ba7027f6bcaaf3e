"""Raw platform payloads -> common CONTENT rows.

Both are pure projections (plus one equi-join of comments to their post for
the post's url and scope), so they pipeline inside one codegen stage per side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions import content as C
from pulse.functions import text as X
from pulse.functions import time as TM
from pulse.schema import (COMMENT, COMMENTS_PER_POST, CONTENT, CONTENT_COLUMNS, CORRUPT_COLUMN, POST,
                          RAW_COMMENT_PAGE, RAW_THREAD, REDDIT, REDDIT_COMMENT_PREFIX,
                          REDDIT_POST_PREFIX, YOUTUBE, YOUTUBE_COMMENT_PREFIX)

ALL_COLUMNS = [f.name for f in CONTENT.fields]


def _observed(observed_at) -> Column:
    if isinstance(observed_at, Column):
        return observed_at
    return TM.observed_at(observed_at)


def normalize_posts(raw_posts: DataFrame, observed_at=None, keep: list[str] | None = None) -> DataFrame:
    """S3 (posts): RAW_POST -> CONTENT. Emoji come from the raw body.
    ``keep`` lists extra input columns carried through unchanged."""
    const = C.constant_columns(REDDIT, POST)
    return raw_posts.select(*(keep or []),
        C.content_id(REDDIT_POST_PREFIX, "id").alias("content_id"),
        _observed(observed_at).alias("observation_time"),
        F.col("author").alias("user"),
        const["user_location"].alias("user_location"),
        const["social_media"].alias("social_media"),
        TM.epoch_to_utc("created_utc").alias("publish_date"),
        const["geo_location"].alias("geo_location"),
        X.clean_thread_text("selftext").alias("comment_raw_text"),
        X.distinct_emoji("selftext").alias("emoji"),
        C.reddit_url("permalink").alias("reference_post_url"),
        F.col("score").cast("bigint").alias("like_count"),
        F.col("num_comments").cast("bigint").alias("reply_count"),
        const["repost_count"].alias("repost_count"),
        const["quote_count"].alias("quote_count"),
        const["bookmark_count"].alias("bookmark_count"),
        const["content_type"].alias("content_type"),
        F.col("subreddit").alias("topic"),
        F.col("subreddit").alias("scope"),
    )


def top_level_only(raw_comments: DataFrame) -> DataFrame:
    """F8: keep comments whose parent is the post itself (drops nested
    replies and unexpanded stubs, which carry no post parent)."""
    return raw_comments.filter(F.col("parent_id") == F.col("post_id"))


def normalize_comments(raw_comments: DataFrame, posts: DataFrame, observed_at=None) -> DataFrame:
    """S3 (comments): RAW_COMMENT -> CONTENT, plus ``post_id`` and ``position``.

    A comment inherits its post's url, topic and scope through an equi-join on
    the post id (the post side is unique per key; AQE broadcasts it when small
    at run time and splits a hot post's comments when large).
    """
    const = C.constant_columns(REDDIT, COMMENT)
    post_keys = posts.select(
        F.col("id").alias("_pid"),
        C.reddit_url("permalink").alias("reference_post_url"),
        F.col("subreddit").alias("topic"),
        F.col("subreddit").alias("scope"),
    )
    joined = raw_comments.join(post_keys, raw_comments["post_id"] == post_keys["_pid"], "inner")
    return joined.select(
        C.content_id(REDDIT_COMMENT_PREFIX, "id").alias("content_id"),
        _observed(observed_at).alias("observation_time"),
        F.col("author").alias("user"),
        const["user_location"].alias("user_location"),
        const["social_media"].alias("social_media"),
        TM.epoch_to_utc("created_utc").alias("publish_date"),
        const["geo_location"].alias("geo_location"),
        X.clean_thread_text("body").alias("comment_raw_text"),
        X.distinct_emoji("body").alias("emoji"),
        F.col("reference_post_url"),
        F.col("score").cast("bigint").alias("like_count"),
        F.lit(0).cast("bigint").alias("reply_count"),
        const["repost_count"].alias("repost_count"),
        const["quote_count"].alias("quote_count"),
        const["bookmark_count"].alias("bookmark_count"),
        const["content_type"].alias("content_type"),
        F.col("topic"),
        F.col("scope"),
        C.content_id(REDDIT_POST_PREFIX, "post_id").alias("post_id"),
        F.col("position").cast("bigint").alias("position"),
    )


def flatten_threads(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts and comments as sibling rows of one CONTENT table."""
    return posts.select(*ALL_COLUMNS).unionByName(comments.select(*ALL_COLUMNS))


def _comment_content(c: Column, url: Column, observed: Column) -> Column:
    """One RAW_COMMENT struct -> a CONTENT struct (comment of a thread)."""
    const = C.constant_columns(REDDIT, COMMENT)
    return F.struct(
        F.concat(F.lit(REDDIT_COMMENT_PREFIX), c.getField("id")).alias("content_id"),
        observed.alias("observation_time"),
        c.getField("author").alias("user"),
        const["user_location"].alias("user_location"),
        const["social_media"].alias("social_media"),
        TM.epoch_to_utc(c.getField("created_utc")).alias("publish_date"),
        const["geo_location"].alias("geo_location"),
        X.clean_thread_text(c.getField("body")).alias("comment_raw_text"),
        X.distinct_emoji(c.getField("body")).alias("emoji"),
        url.alias("reference_post_url"),
        c.getField("score").cast("bigint").alias("like_count"),
        F.lit(0).cast("bigint").alias("reply_count"),
        const["repost_count"].alias("repost_count"),
        const["quote_count"].alias("quote_count"),
        const["bookmark_count"].alias("bookmark_count"),
        const["content_type"].alias("content_type"),
    )


def normalize_thread_payload(payloads: DataFrame, payload_col: str = "payload",
                             comment_limit: int = COMMENTS_PER_POST, observed_at=None,
                             keep: list[str] | None = None) -> DataFrame:
    """S3 + F8 + L2 + D6 for one landed scrape per row (RAW_THREAD as JSON
    text or struct) -> THREAD documents, row-locally: top-level comments in
    listing order, the first ``comment_limit`` kept, nested under the post.
    No shuffle, so it runs unchanged inside a streaming query. A payload without
    a post becomes a row with only ``_corrupt_record`` set (F7); ``keep`` lists
    input columns (e.g. the arrival) carried through."""
    col = F.col(payload_col)
    if dict(payloads.dtypes)[payload_col] == "string":
        col = F.from_json(col, RAW_THREAD)
    text = F.col(payload_col).cast("string") if dict(payloads.dtypes)[payload_col] == "string" else F.to_json(F.col(payload_col))
    flat = payloads.select(col.alias("_t"), F.coalesce(text, F.lit("")).alias("_text"), *(keep or []))
    flat = flat.select("_t.post.*", F.col("_t.comments").alias("_raw"),
                       F.when(F.col("_t.post.id").isNull(), F.col("_text")).alias(CORRUPT_COLUMN), *(keep or []))
    observed = _observed(observed_at)
    top = F.filter(F.coalesce("_raw", F.array().cast(f"array<{RAW_THREAD['comments'].dataType.elementType.simpleString()}>")),
                   lambda c: c.getField("parent_id") == c.getField("post_id"))
    ordered = F.array_sort(top, lambda a, b: F.when(a.getField("position") < b.getField("position"), -1)
                           .when(a.getField("position") > b.getField("position"), 1).otherwise(0))
    head = F.slice(ordered, 1, max(comment_limit, 0))
    posts = normalize_posts(flat.withColumn("_head", head), observed, keep=["_head", CORRUPT_COLUMN, *(keep or [])])
    # a payload that is no scrape keeps its text and nothing else
    data = [c for c in posts.columns if c not in ("_head", CORRUPT_COLUMN, *(keep or []))]
    posts = posts.select("_head", CORRUPT_COLUMN, *(keep or []),
                         *[F.when(F.col(CORRUPT_COLUMN).isNull(), F.col(c)).alias(c) for c in data])
    out = posts.withColumn("comments", F.transform(
        "_head", lambda c: _comment_content(c, F.col("reference_post_url"), observed))).drop("_head")
    return out.select(*data, "comments", *(keep or []), CORRUPT_COLUMN)


def normalize_comment_items(items: DataFrame, observed_at=None, keep: list[str] | None = None) -> DataFrame:
    """S4 core: one row per comment item (columns ``query``, ``videoId``,
    ``item``, and those of ``keep``) -> CONTENT. Emoji come from the *cleaned* text. An unparseable
    ``publishedAt`` yields a null ``publish_date`` (quarantined as bad_time)."""
    const = C.constant_columns(YOUTUBE, COMMENT)
    top = F.col("item.snippet.topLevelComment")
    snip = top.getField("snippet")
    cleaned = X.clean_comment_text(snip.getField("textDisplay"))
    return items.select(
        C.content_id(YOUTUBE_COMMENT_PREFIX, top.getField("id")).alias("content_id"),
        _observed(observed_at).alias("observation_time"),
        snip.getField("authorDisplayName").alias("user"),
        const["user_location"].alias("user_location"),
        const["social_media"].alias("social_media"),
        TM.parse_utc(snip.getField("publishedAt")).alias("publish_date"),
        const["geo_location"].alias("geo_location"),
        cleaned.alias("comment_raw_text"),
        X.distinct_emoji(cleaned).alias("emoji"),
        C.youtube_url("videoId").alias("reference_post_url"),
        snip.getField("likeCount").cast("bigint").alias("like_count"),
        F.col("item.snippet.totalReplyCount").cast("bigint").alias("reply_count"),
        const["repost_count"].alias("repost_count"),
        const["quote_count"].alias("quote_count"),
        const["bookmark_count"].alias("bookmark_count"),
        const["content_type"].alias("content_type"),
        F.col("query").alias("topic"),
        F.col("videoId").alias("scope"),
        *(keep or []),
    )


def normalize_comment_pages(pages: DataFrame, payload_col: str = "payload",
                            observed_at=None, keep: list[str] | None = None) -> DataFrame:
    """Raw JSON comment-thread pages -> CONTENT rows with ``position`` (the
    place of the item in its page's listing) and ``_corrupt_record``.

    ``payload_col`` holds one page as JSON text (or already as a struct).
    Parsing is ``from_json`` with the declared page schema; items are exploded
    row-locally, so the work is split exactly like the input files. A payload
    that is no page becomes one row with only ``_corrupt_record`` set, which the
    quarantine (F7) routes aside; a page without items gives no rows. ``keep``
    lists input columns (e.g. the arrival of the page) carried through.
    """
    kind = dict(pages.dtypes)[payload_col]
    col = F.from_json(F.col(payload_col), RAW_COMMENT_PAGE) if kind == "string" else F.col(payload_col)
    text = F.col(payload_col) if kind == "string" else F.to_json(F.col(payload_col))
    extra = ["position", CORRUPT_COLUMN, *(keep or [])]
    parsed = pages.select(col.alias("_page"), F.coalesce(text, F.lit("")).alias("_text"), *(keep or []))
    broken = F.col("_page.query").isNull() & F.col("_page.videoId").isNull() & F.col("_page.items").isNull()
    rows = parsed.select(
        F.col("_page.query").alias("query"), F.col("_page.videoId").alias("videoId"),
        F.when(broken, F.col("_text")).alias(CORRUPT_COLUMN), *(keep or []),
        F.posexplode_outer("_page.items").alias("position", "item"))
    rows = rows.filter(F.col("position").isNotNull() | F.col(CORRUPT_COLUMN).isNotNull())
    out = normalize_comment_items(rows, observed_at, keep=extra)
    return out.select(*[(c if c in extra else F.when(F.col(CORRUPT_COLUMN).isNull(), F.col(c)).alias(c)) for c in out.columns])


__all__ = [
    "normalize_posts", "normalize_comments", "top_level_only", "flatten_threads",
    "normalize_comment_items", "normalize_comment_pages", "CONTENT_COLUMNS",
]
