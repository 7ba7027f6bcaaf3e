"""Per-group top-n in feed order, limit-then-skip, preview.

``row_number() <= n`` is planned by Spark as a *partial* WindowGroupLimit
before the shuffle and a final one after it, so a hot group ships at most
``n`` rows per map task - the skew-safe way to take a per-group head.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.schema import COMMENTS_PER_POST, COMMENTS_PER_VIDEO, POSTS_PER_RUN, VIDEOS_PER_RUN


def top_n(df: DataFrame, partition_cols: list[str], order_cols: list, n: int,
          rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group in the given (total) order; n <= 0 keeps none."""
    if n <= 0:
        return df.limit(0) if rank_col is None else df.withColumn(rank_col, F.lit(0)).limit(0)
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def top_posts(posts: DataFrame, n: int = POSTS_PER_RUN, rank_col: str | None = None) -> DataFrame:
    """L1: first n posts of each community, in feed rank order."""
    return top_n(posts, ["scope"], ["rank", "id"], n, rank_col)


def top_comments(comments: DataFrame, n: int = COMMENTS_PER_POST,
                 rank_col: str | None = None) -> DataFrame:
    """L2: first n top-level comments of each post, in listing order."""
    return top_n(comments, ["post_id"], ["position", "content_id"], n, rank_col)


def top_videos(items: DataFrame, n: int = VIDEOS_PER_RUN, rank_col: str | None = None) -> DataFrame:
    """L3: first n search hits per topic (``rank`` is the hit order)."""
    return top_n(items, ["topic"], ["rank", "scope"], n, rank_col)


def top_video_comments(comments: DataFrame, n: int = COMMENTS_PER_VIDEO,
                       order_cols: list | None = None, rank_col: str | None = None) -> DataFrame:
    """L4: first n comments per video, in listing order (position in the page)."""
    return top_n(comments, ["scope"], order_cols or ["position", "content_id"], n, rank_col)


def limit_then_skip_seen(df: DataFrame, n: int, ledger: DataFrame | None,
                         partition_cols: list[str], order_cols: list,
                         keys: list[str] | None = None) -> DataFrame:
    """The per-group limit is applied *before* the seen-check, so items
    already seen use up the quota (as in the collectors)."""
    from pulse.operators.dedup import skip_seen
    return skip_seen(top_n(df, partition_cols, order_cols, n), ledger, keys)


def head_and_shape(df: DataFrame, order_cols: list, n: int = 5) -> DataFrame:
    """The first ``n`` rows plus the frame's shape as two columns.

    The row count is a scalar subquery (one aggregate job, partial counts per
    task), the head a TakeOrderedAndProject - neither moves the table.
    """
    n_rows = df.select(F.count(F.lit(1))).scalar()
    return (df.orderBy(*order_cols).limit(n)
            .withColumn("n_rows", n_rows)
            .withColumn("n_cols", F.lit(len(df.columns)).cast("bigint")))
