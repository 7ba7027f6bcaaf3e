"""Bindings of the driver's parquet tables to the social-content model.

The test tables stand in for landed platform payloads:

* ``documents``     -> video comments: topic = ``lang``, scope (video) =
                        ``source``, author = ``source``, text = ``text``.
* ``conversations`` -> threads: the opening turn (turn 0) is the post, later
                        turns are its comments in turn order; the community
                        (subreddit) is the role of the opening turn.
* ``events``        -> repeated sightings: scope = ``event_type``, item =
                        ``user_id``, arrival = (``ts``, ``event_id``).
* ``pages``         -> URL-bearing raw text (``html``).
* ``labels``        -> training labels for the trained scorer.

Publish instants are derived from the ids (monotone in arrival order) from a
fixed origin, so phase and time-window reports have something to cut.
Every binding is a projection / equi-join over whole tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.time import PLATFORM_FORMAT
from pulse.session import materialised
from pulse.sources import normalize as N

# Origin of derived publish instants: 2025-05-25T00:00:00Z.
ORIGIN_EPOCH = 1748131200
COMMENT_SPACING_S = 60      # one comment per minute of doc_id
THREAD_SPACING_S = 600      # one thread per ten minutes of conv_id
TURN_SPACING_S = 30         # turns of a thread 30 s apart (turn < 20)
OBSERVED_AT = "2025-05-26T00:00:00+00:00"
PAGE_SIZE = 25              # comment items per landed page


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over the cluster when it has fewer splits than cores.

    A table stored as a few large row groups scans in a few tasks, and all
    row-local text work (regex cleaning, tokenising, scoring) would run on
    those few cores. Only then the rows are dealt round-robin to
    ``defaultParallelism`` partitions; a large table already has more splits
    than cores and is left alone (no shuffle). The split count is known at
    planning time - no job runs for the check.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(target) if splits < target else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))


# ---------------------------------------------------------------- threads
def raw_thread_payload(spark: SparkSession, sf_dir: str, reply_chain: bool = False):
    """(RAW_POST, RAW_COMMENT) frames from ``conversations``.

    With ``reply_chain`` each turn answers the previous one, so only turn 1
    is a top-level comment; otherwise every later turn answers the post.
    """
    conv = table(spark, sf_dir, "conversations")
    n_comments = (conv.groupBy("conv_id")
                  .agg(F.count_if(F.col("turn") > 0).cast("bigint").alias("num_comments")))
    opening = conv.filter(F.col("turn") == 0)
    created = (F.lit(ORIGIN_EPOCH) + F.col("conv_id") * THREAD_SPACING_S
               + F.col("turn") * TURN_SPACING_S).cast("double")
    # left join on a key-unique aggregate: Catalyst removes it wherever the
    # count is not used (e.g. when only texts and labels are needed)
    posts = opening.join(n_comments, "conv_id", "left").select(
        F.col("conv_id").cast("string").alias("id"),
        F.concat(F.lit("/r/"), F.col("role"), F.lit("/comments/"),
                 F.col("conv_id").cast("string"), F.lit("/")).alias("permalink"),
        created.alias("created_utc"),
        F.col("role").alias("author"),
        F.col("text").alias("selftext"),
        F.length("text").cast("bigint").alias("score"),
        F.coalesce(F.col("num_comments"), F.lit(0).cast("bigint")).alias("num_comments"),
        F.col("conv_id").alias("rank"),
        F.col("role").alias("subreddit"),
    )
    cid = F.concat(F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
    prev = F.concat(F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - 1).cast("string"))
    parent = F.col("conv_id").cast("string")
    if reply_chain:
        parent = F.when(F.col("turn") == 1, parent).otherwise(prev)
    comments = conv.filter(F.col("turn") > 0).select(
        cid.alias("id"),
        F.col("conv_id").cast("string").alias("post_id"),
        parent.alias("parent_id"),
        F.col("turn").alias("position"),
        created.alias("created_utc"),
        F.col("role").alias("author"),
        F.col("text").alias("body"),
        F.length("text").cast("bigint").alias("score"),
    )
    return posts, comments


def thread_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed scrapes as JSON text: one post with the comments fetched with
    it. A scrape fetches at most COMMENTS_PER_POST comments, so the first
    ones per post are taken with a partial top-n before they are collected
    (bounded arrays, however many comments a post has)."""
    from pulse.operators.limits import top_n
    from pulse.schema import COMMENTS_PER_POST
    raw_posts, raw_comments = raw_thread_payload(spark, sf_dir)
    fetched = top_n(raw_comments, ["post_id"], ["position", "id"], COMMENTS_PER_POST)
    nested = (fetched.groupBy("post_id")
              .agg(F.array_sort(F.collect_list(F.struct(*raw_comments.columns))).alias("comments")))
    joined = raw_posts.join(nested, raw_posts["id"] == nested["post_id"], "left")
    post = F.struct(*[F.col(c) for c in raw_posts.columns])
    return joined.select(F.to_json(F.struct(post.alias("post"), F.col("comments"))).alias("payload"))


def thread_rows(spark: SparkSession, sf_dir: str):
    """(posts, comments) as CONTENT rows; comments carry post_id/position."""
    raw_posts, raw_comments = raw_thread_payload(spark, sf_dir)
    posts = N.normalize_posts(raw_posts, OBSERVED_AT)
    comments = N.normalize_comments(N.top_level_only(raw_comments), raw_posts, OBSERVED_AT)
    return posts, comments


def source_threads(spark: SparkSession, sf_dir: str):
    """(posts, comments) with large threads: the documents of a source, the one
    with the smallest id as the post and the others as its comments."""
    rows = comment_rows(spark, sf_dir)
    ids = F.regexp_extract("content_id", r"(\d+)$", 1).cast("bigint")
    # cleaned once: posts and comments, their texts and their parts all read these rows
    rows = materialised(rows.withColumn("position", ids), "source_rows")
    first = rows.groupBy(F.col("scope").alias("_scope")).agg(F.min("position").alias("_first"))
    rows = rows.join(first, rows["scope"] == first["_scope"])
    is_post = F.col("position") == F.col("_first")
    posts = rows.filter(is_post).drop("_scope", "_first", "position")
    comments = rows.filter(~is_post).withColumn("post_id", F.concat(F.lit("yt_comm_"), F.col("_first").cast("string")))
    return posts, comments.drop("_scope", "_first")


# --------------------------------------------------------------- comments
def _comment_item():
    published = F.date_format(
        F.timestamp_seconds(F.lit(ORIGIN_EPOCH) + F.col("doc_id") * COMMENT_SPACING_S),
        PLATFORM_FORMAT)
    replies = F.length("text") - F.length(F.regexp_replace("text", "\n", ""))
    return F.struct(F.struct(
        replies.cast("bigint").alias("totalReplyCount"),
        F.struct(
            F.col("doc_id").cast("string").alias("id"),
            F.struct(
                published.alias("publishedAt"),
                F.col("text").alias("textDisplay"),
                F.col("source").alias("authorDisplayName"),
                F.col("n_chars").alias("likeCount"),
            ).alias("snippet"),
        ).alias("topLevelComment"),
    ).alias("snippet"))


def comment_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw comment item per document (``query``, ``videoId``, ``item``)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("lang").alias("query"), F.col("source").alias("videoId"),
                       _comment_item().alias("item"), F.col("doc_id"))


def comment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed comment pages as JSON text, at most PAGE_SIZE items each.

    Items are grouped per (query, video, id block); the group size is bounded
    by the page size, so no group can grow with the data.
    """
    return _paged(comment_items(spark, sf_dir), ["doc_id"]).select("payload")


def _paged(items: DataFrame, order: list[str]) -> DataFrame:
    """``page, payload``: comment items of a (query, video, id block) as one page
    of JSON text, listed in ``order``."""
    page = F.floor(F.col("doc_id") / PAGE_SIZE)
    grouped = (items.groupBy("query", "videoId", page.alias("page"))
               .agg(F.array_sort(F.collect_list(F.struct(*order, "item"))).alias("_items")))
    payload = F.to_json(F.struct(
        F.col("query"), F.col("videoId"),
        F.transform("_items", lambda x: x.getField("item")).alias("items")))
    return grouped.select("page", payload.alias("payload"))


def faulty_comment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page, payload``: the landed pages with faults derived from the comments'
    own lengths (no id, no time), and one page that is no JSON."""
    items = comment_items(spark, sf_dir)
    n = F.col("item.snippet.topLevelComment.snippet.likeCount")
    top = F.col("item.snippet.topLevelComment")
    snip = top.getField("snippet").withField("publishedAt", F.when(n % 13 != 0, top.getField("snippet").getField("publishedAt")))
    top = top.withField("id", F.when(n % 11 != 0, top.getField("id"))).withField("snippet", snip)
    items = items.withColumn("item", F.col("item").withField("snippet", F.col("item.snippet").withField("topLevelComment", top)))
    pages = _paged(items, ["doc_id"]).select("page", "payload")
    broken = spark.range(1).select(F.lit(-1).cast("bigint").alias("page"), F.lit('{"query": "x", "items": [').alias("payload"))
    return pages.unionByName(broken)


def listed_comment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page, payload`` with the items of a page listed longest first, which is
    not the order of their times."""
    items = comment_items(spark, sf_dir)
    longest = (-F.col("item.snippet.topLevelComment.snippet.likeCount")).alias("longest")
    return _paged(items.select("*", longest), ["longest", "doc_id"]).select("page", "payload")


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topic, scope, rank``: videos as a search lists them (most text first)."""
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy(F.col("lang").alias("topic"), F.col("source").alias("scope")).agg(
        (-F.sum("n_chars")).alias("rank"))


def comment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video comments as CONTENT rows (same result as parsing the pages)."""
    return N.normalize_comment_items(comment_items(spark, sf_dir), OBSERVED_AT)


# ----------------------------------------------------------- observations
def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated sightings: (social_media, scope, content_id, arrival_ts, event_id, value)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.lit("events").alias("social_media"),
        F.col("event_type").alias("scope"),
        F.concat(F.lit("item_"), F.col("user_id").cast("string")).alias("content_id"),
        F.col("ts").cast("timestamp").alias("arrival_ts"),
        F.col("event_id"),
        F.col("value"),
    )
