"""Nesting comments under posts and gluing a thread into a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.text import has_text
from pulse.operators.filters import drop_blank_comments
from pulse.operators.limits import top_comments
from pulse.operators.sequence import number_rows
from pulse.schema import COMMENT_STRUCT, CONTENT_COLUMNS, REDDIT, THREAD_SEPARATOR, YOUTUBE

#: comments in a row of a thread that is nested in parts
PART_COMMENTS = 500


def _empty_comments() -> Column:
    return F.array().cast(f"array<{COMMENT_STRUCT.simpleString()}>")


def nest_threads(posts: DataFrame, comments: DataFrame, limit: int | None = None) -> DataFrame:
    """Each post with an array of its comments, in listing order.

    All comments are kept. A collection run passes its ``limit`` (L2), which is
    applied with a partial top-n *before* the comments are collected. Nesting
    makes documents; scoring and reports work on flat rows (``score_thread_rows``
    and ``thread_texts``), so they never gather a post's comments in one array.
    Posts without comments keep an empty array.
    """
    if limit is not None and limit <= 0:
        return posts.withColumn("comments", _empty_comments())
    head = comments if limit is None else top_comments(comments, limit)
    entry = F.struct(F.col("position"), F.col("content_id").alias("_id"),
                     F.struct(*CONTENT_COLUMNS).alias("c"))
    nested = (head.groupBy("post_id")
              .agg(F.array_sort(F.collect_list(entry)).alias("_cs"))
              .select(F.col("post_id").alias("_post"),
                      F.transform("_cs", lambda x: x.getField("c")).alias("comments")))
    joined = posts.join(nested, posts["content_id"] == nested["_post"], "left").drop("_post")
    empty = F.array().cast(joined.schema["comments"].dataType)
    return joined.withColumn("comments", F.coalesce(F.col("comments"), empty))


def nest_parts(comments: DataFrame, size: int = PART_COMMENTS) -> DataFrame:
    """D6 for threads of any length: ``post_id, part, comments`` with at most
    ``size`` comments a row, in listing order over the parts of a post (from 0).

    Ids alone are numbered, by ranges, so neither a task nor a row holds a hot post;
    the comments then meet their numbers by id and are shuffled once more, by part.
    Copies of a comment (equal id and position) share a number.
    """
    width = int(comments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["post_id", "position", "content_id"]
    numbered = number_rows(comments.select(*keys).distinct(), keys[:1], keys[1:], "_n", num_partitions=width)
    numbered = numbered.select(*[F.col(k).alias(f"_{k}") for k in keys], "_n")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    rows = comments.join(numbered, same)
    entry = F.struct(F.col("_n"), F.struct(*CONTENT_COLUMNS).alias("c"))
    return (rows.groupBy("post_id", F.floor((F.col("_n") - 1) / size).alias("part"))
            .agg(F.array_sort(F.collect_list(entry)).alias("_cs"))
            .select("post_id", "part", F.transform("_cs", lambda x: x.getField("c")).alias("comments")))


def thread_text(post_text: Column | str = "comment_raw_text",
                comments: Column | str = "comments") -> Column:
    """Post text (if any) then `` commento:`` + each non-blank comment.

    A blank post leaves the text starting with the separator. Every comment brings
    its own separator and the pieces are joined once, in array order: a fold
    would copy the text so far for every comment.
    """
    post = F.col(post_text) if isinstance(post_text, str) else post_text
    cs = F.col(comments) if isinstance(comments, str) else comments
    start = F.when(has_text(post), post).otherwise(F.lit(""))
    pieces = F.transform(drop_blank_comments(F.coalesce(cs, _empty_comments())),
                         lambda c: F.concat(F.lit(THREAD_SEPARATOR), c.getField("comment_raw_text")))
    return F.concat(start, F.array_join(pieces, ""))


def item_texts(df: DataFrame) -> Column:
    """D8 helper: the individual non-blank texts of an item, in order.

    Comment -> [text]; thread -> [post text] + non-blank comment texts. Texts
    stay attached to their own item, so pairing them with the item's label is
    exact (the original zipped two flat lists by position).
    """
    own = F.when(has_text(F.col("comment_raw_text")), F.array(F.col("comment_raw_text"))) \
           .otherwise(F.array().cast("array<string>"))
    if "comments" not in df.columns:
        return own
    kids = F.transform(drop_blank_comments(F.coalesce(F.col("comments"), _empty_comments())),
                       lambda c: c.getField("comment_raw_text"))
    return F.concat(own, kids)


def thread_texts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """D8 over flat rows: every non-blank text of a thread with the thread's id
    (``item_id``, ``is_post``, ``text``), without nesting."""
    own = posts.select(F.col("content_id").alias("item_id"), F.lit(True).alias("is_post"),
                       F.col("comment_raw_text").alias("text"))
    kids = comments.select(F.col("post_id").alias("item_id"), F.lit(False).alias("is_post"),
                           F.col("comment_raw_text").alias("text"))
    return own.unionByName(kids).filter(has_text("text"))


def route_by_platform(df: DataFrame):
    """Split a mixed frame into (threads, comments) by platform."""
    return (df.filter(F.col("social_media") == REDDIT),
            df.filter(F.col("social_media") == YOUTUBE))
