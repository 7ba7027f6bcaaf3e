"""Declared schemas and fixed values of the social-content data model.

Every record - a post or a comment - shares one 16-column layout (``CONTENT``);
a thread document is a post plus an array of its comments (``THREAD``). The
engine adds ``topic`` and ``scope`` so that the community / search topic that
produced a row travels with it instead of living in a file name.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values. These must equal the values the original application used,
# so they are stated plainly, in their natural order.
# --------------------------------------------------------------------------

# Ordered sentiment scale; position in the list is the ordinal 0..4.
LABELS = ["Very Negative", "Negative", "Neutral", "Positive", "Very Positive"]
NEUTRAL = "Neutral"
NEUTRAL_ORDINAL = 2

# Display colour for each label, same order as LABELS.
LABEL_COLOURS = ["darkred", "red", "gray", "lightgreen", "green"]

# Platform names and content types.
REDDIT = "Reddit"
YOUTUBE = "YouTube"
PLATFORMS = [REDDIT, YOUTUBE]
POST = "post"
COMMENT = "commento"

# Content id prefixes.
REDDIT_POST_PREFIX = "reddit_post_"
REDDIT_COMMENT_PREFIX = "reddit_comm_"
YOUTUBE_COMMENT_PREFIX = "yt_comm_"

# Reference URL prefixes.
REDDIT_SITE = "https://www.reddit.com"
YOUTUBE_WATCH = "https://www.youtube.com/watch?v="

# Separator placed before every comment when a thread is glued into one text.
THREAD_SEPARATOR = " commento:"

# Defaults for absent keys in a staged document.
DEFAULT_CONTENT_ID = "Unknown ID"
DEFAULT_PLATFORM = "Unknown"

# Context words removed from term clouds on top of the language stop-words.
DOMAIN_STOPWORDS = ["post", "comment", "reddit", "youtube", "video", "watch", "link", "https", "http"]

# Default limits of a collection run.
POSTS_PER_RUN = 10
COMMENTS_PER_POST = 20
VIDEOS_PER_RUN = 3
COMMENTS_PER_VIDEO = 25

# Staged items are discovered in pages of this many keys (files per trigger).
DISCOVERY_PAGE = 50

# Token cap of the comment scorer.
MAX_SCORED_TOKENS = 512

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

CONTENT_FIELDS = [
    T.StructField("content_id", T.StringType(), False),
    T.StructField("observation_time", T.TimestampType()),
    T.StructField("user", T.StringType()),
    T.StructField("user_location", T.StringType()),
    T.StructField("social_media", T.StringType()),
    T.StructField("publish_date", T.TimestampType()),
    T.StructField("geo_location", T.StringType()),
    T.StructField("comment_raw_text", T.StringType()),
    T.StructField("emoji", T.ArrayType(T.StringType())),
    T.StructField("reference_post_url", T.StringType()),
    T.StructField("like_count", T.LongType()),
    T.StructField("reply_count", T.LongType()),
    T.StructField("repost_count", T.LongType()),
    T.StructField("quote_count", T.LongType()),
    T.StructField("bookmark_count", T.LongType()),
    T.StructField("content_type", T.StringType()),
]
CONTENT_COLUMNS = [f.name for f in CONTENT_FIELDS]
CONTEXT_FIELDS = [
    T.StructField("topic", T.StringType()),
    T.StructField("scope", T.StringType()),
]

CONTENT = T.StructType(CONTENT_FIELDS + CONTEXT_FIELDS)
COMMENT_STRUCT = T.StructType(CONTENT_FIELDS)
THREAD = T.StructType(CONTENT_FIELDS + CONTEXT_FIELDS
                      + [T.StructField("comments", T.ArrayType(COMMENT_STRUCT))])

# Staged documents are read leniently: every field nullable, plus the column
# that receives a line that is not valid JSON.
CORRUPT_COLUMN = "_corrupt_record"


# K2: number of the staging and position in it, carried by staged documents.
STAGED_ORDER = ["staged_seq", "staged_pos"]


def lenient(schema: T.StructType) -> T.StructType:
    """Same fields, all nullable, plus the corrupt-record column."""
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    return T.StructType(fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


LEDGER = T.StructType([
    T.StructField("social_media", T.StringType(), False),
    T.StructField("scope", T.StringType(), False),
    T.StructField("content_id", T.StringType(), False),
])

# Raw platform payloads, as landed by a collector.
RAW_POST = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("created_utc", T.DoubleType()),
    T.StructField("author", T.StringType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("rank", T.LongType()),
    T.StructField("subreddit", T.StringType()),
])

RAW_COMMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("post_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("position", T.LongType()),
    T.StructField("created_utc", T.DoubleType()),
    T.StructField("author", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("score", T.LongType()),
])

# One scraped thread as landed: the post and the comments fetched with it.
RAW_THREAD = T.StructType([
    T.StructField("post", RAW_POST),
    T.StructField("comments", T.ArrayType(RAW_COMMENT)),
])

RAW_COMMENT_SNIPPET = T.StructType([
    T.StructField("publishedAt", T.StringType()),
    T.StructField("textDisplay", T.StringType()),
    T.StructField("authorDisplayName", T.StringType()),
    T.StructField("likeCount", T.LongType()),
])
RAW_COMMENT_ITEM = T.StructType([
    T.StructField("snippet", T.StructType([
        T.StructField("totalReplyCount", T.LongType()),
        T.StructField("topLevelComment", T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("snippet", RAW_COMMENT_SNIPPET),
        ])),
    ])),
])
RAW_COMMENT_PAGE = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("videoId", T.StringType()),
    T.StructField("items", T.ArrayType(RAW_COMMENT_ITEM)),
])

LEXICON = T.StructType([
    T.StructField("word", T.StringType(), False),
    T.StructField("weight", T.IntegerType(), False),
])

PHASES = T.StructType([
    T.StructField("phase", T.StringType(), False),
    T.StructField("start", T.TimestampType(), False),
    T.StructField("end", T.TimestampType(), False),
])
