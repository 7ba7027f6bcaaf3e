"""Batch jobs composed from the operators: one collection cycle per platform,
labelling of staged documents, and the report over the labelled store.

These are the batch counterparts of the streaming jobs; every step is a
DataFrame transformation. A cycle skips what the ledger has before it stages,
appends by key and writes new dataset versions, so re-running it on the same
input adds nothing; documents that fail the quarantine are written with their
reason.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.content import with_defaults
from pulse.operators import dedup as D
from pulse.operators import filters as FL
from pulse.operators import limits as L
from pulse.operators.ledger import Ledger
from pulse.operators.threads import nest_threads
from pulse.schema import (COMMENTS_PER_POST, COMMENTS_PER_VIDEO, CORRUPT_COLUMN, POSTS_PER_RUN, REDDIT, STAGED_ORDER,
                          VIDEOS_PER_RUN, YOUTUBE)
from pulse.session import materialised
from pulse.sinks.files import latest_staged, stage_keyed, write_topic
from pulse.sources import normalize as N
from pulse.sources.files import read_comments, read_threads, read_topic_csv
from pulse.streaming.jobs import append_new, append_rejects, final_report


def _instant(observed_at: str | None) -> str:
    """P5: the one observation instant of a run, fixed at its start."""
    return observed_at or dt.datetime.now(dt.timezone.utc).isoformat()


def append_topic(new: DataFrame, path: str, order_cols: list[str]) -> DataFrame:
    """K1: add what a cycle found to the topic dataset at ``path``; first observation wins.

    The dataset is Parquet with the columns ``cycle`` and ``arrival`` (the place in the
    cycle by ``order_cols``) kept. Rows are never rewritten: ids stored before are
    found in the buckets of the dataset's ledger that the cycle touches, so a
    cycle costs its own rows. Returns the rows that were added.
    """
    spark, run = new.sparkSession, uuid.uuid4().hex
    firsts = D.keep_first(new.withColumn("arrival", F.to_json(F.struct(*order_cols))), ["content_id"], order_cols)
    firsts = materialised(firsts, "topic-firsts")
    look = Ledger(spark, f"{path.rstrip('/')}_ledger", ["content_id"]).lookup(firsts, run)
    fresh = materialised(look.unseen().withColumn("cycle", F.lit(run)), "topic-fresh")
    fresh.write.mode("append").parquet(path)
    look.record(fresh)
    return fresh


def collect_threads(spark: SparkSession, raw_posts: DataFrame, raw_comments: DataFrame,
                    ledger_path: str, staging_path: str, topic_in: str | None, topic_out: str | None,
                    post_limit: int = POSTS_PER_RUN, comment_limit: int = COMMENTS_PER_POST,
                    observed_at: str | None = None, rejects: str | None = None,
                    topic_store: str | None = None) -> DataFrame:
    """One thread-collection cycle over landed payloads.

    L1 first posts per community -> D1 skip posts already seen in that
    community (limit first, L5) -> S3 normalise, F8 top-level comments, L2
    first comments per post -> D6 nest -> K2 stage thread documents -> K4
    record post ids -> D5 flatten -> D2/K1 merge keep-first into a new
    version of the topic dataset (``topic_out``, a CSV export, and ``topic_store``, the
    dataset that grows by new rows only). Returns the flat rows of this cycle.
    """
    observed_at = _instant(observed_at)
    posts = L.top_posts(raw_posts.withColumn("scope", F.col("subreddit")), post_limit).drop("scope")
    content = N.normalize_posts(posts, observed_at)
    no_id = F.col("content_id").isNull()
    if rejects:
        append_rejects(content.filter(no_id).withColumn("reason", F.lit(FL.MISSING_ID)), rejects)
    content = materialised(content.filter(~no_id), "posts")      # read by the lookup and the join
    seen = Ledger(spark, ledger_path).lookup(content, uuid.uuid4().hex)
    fresh = materialised(seen.unseen(), "fresh-posts")
    comments = N.normalize_comments(N.top_level_only(raw_comments), posts, observed_at)
    comments = comments.join(fresh.select(F.col("content_id").alias("post_id")), "post_id", "left_semi")
    threads = nest_threads(fresh, comments, comment_limit)
    stage_keyed(threads, staging_path)
    seen.record(fresh)
    flat = N.flatten_threads(fresh, L.top_comments(comments, comment_limit))
    if topic_store:
        append_topic(flat, topic_store, ["publish_date", "scope"])
    if topic_out:
        _merge_topic(spark, flat, topic_in, topic_out)
    return flat


def collect_comments(spark: SparkSession, pages: DataFrame, ledger_path: str, staging_path: str,
                     topic_in: str | None, topic_out: str | None, video_limit: int = VIDEOS_PER_RUN,
                     comment_limit: int = COMMENTS_PER_VIDEO, observed_at: str | None = None,
                     payload_col: str = "payload", hits: DataFrame | None = None,
                     page_col: str | None = None, rejects: str | None = None,
                     topic_store: str | None = None) -> DataFrame:
    """One comment-collection cycle over landed comment pages.

    S4 normalise -> F7 quarantine -> L3 first videos per topic (``hits``: topic,
    scope, rank of the search) -> L4 first comments per video in listing order
    (``page_col`` numbers the pages, then the position in the page) -> D1 skip
    comments seen for that video -> K2 stage -> K4 record -> K1 merge into the
    topic dataset (as above; ties by the place in the listing). Without ``hits`` all
    videos of the pages are taken.
    """
    observed_at = _instant(observed_at)
    keep = [page_col] if page_col else []
    rows = N.normalize_comment_pages(pages, payload_col, observed_at, keep=keep)
    ok, rejected = FL.quarantine(rows)
    if rejects:
        append_rejects(rejected, rejects)
    if hits is not None:
        picked = L.top_videos(hits, video_limit).select("topic", "scope")
        ok = ok.join(picked, ["topic", "scope"], "left_semi")
    head = L.top_video_comments(ok, comment_limit, [*keep, "position", "content_id"])
    listed = [*keep, "position"]
    head = materialised(head.select(*N.ALL_COLUMNS, *listed), "comments")
    seen = Ledger(spark, ledger_path).lookup(head, uuid.uuid4().hex)
    placed = materialised(seen.unseen(), "fresh-comments")
    fresh = placed.select(*N.ALL_COLUMNS)
    stage_keyed(fresh, staging_path)
    seen.record(fresh)
    if topic_store:
        append_topic(placed, topic_store, [*listed, "scope"])
    if topic_out:
        _merge_topic(spark, fresh, topic_in, topic_out)
    return fresh


def _merge_topic(spark: SparkSession, new: DataFrame, topic_in: str | None, topic_out: str) -> None:
    from pulse.sinks.files import to_csv_columns
    new_csv = to_csv_columns(new)
    existing = read_topic_csv(spark, topic_in, new_csv.schema) if topic_in else None
    merged = D.union_keep_first(existing, new_csv, "content_id", ["observation_time", "publish_date", "scope"])
    write_topic(merged, topic_out)


def label_staged(spark: SparkSession, threads_path: str | None, comments_path: str | None,
                 store: str, label_threads, label_comments, rejects: str | None = None) -> None:
    """Batch W2: of the staged documents the last of each id (K2), quarantine, label each
    platform with its own rule (D7), append the whole documents whose key is new (K3). Rejected
    documents go to ``rejects`` (``<store>_rejects`` by default)."""
    rejects = rejects or f"{store.rstrip('/')}_rejects"
    parts = []
    for path, reader, platform, label, thread in ((threads_path, read_threads, REDDIT, label_threads, True),
                                                  (comments_path, read_comments, YOUTUBE, label_comments, False)):
        if path:
            last = latest_staged(reader(spark, path, sequence=True)).drop("_row", *STAGED_ORDER)
            last = materialised(last, "staged-last")      # read for the rejects and for the labels
            ok, rejected = FL.quarantine(last)
            append_rejects(rejected, rejects)
            parts.append(label(with_defaults(ok, thread=thread).filter(F.col("social_media") == platform)))
    labelled = parts[0]
    for p in parts[1:]:
        labelled = labelled.unionByName(p, allowMissingColumns=True)
    append_new(labelled.drop(CORRUPT_COLUMN).withColumn("labelled_at", F.current_timestamp()), store, ["content_id"])


def report(spark: SparkSession, store: str, out: str | None = None) -> dict[str, DataFrame]:
    """The report tables over everything in the labelled store."""
    return final_report(spark, store, out)
