"""Shared building blocks of the query catalogue (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.text import has_text
from pulse.operators.sentiment import LexiconScorer, score_comments, score_thread_rows
from pulse.operators.threads import nest_threads, thread_texts
from pulse.session import configure
from pulse.sources import tables as TB

# Test lexicon for the driver tables (a fixture, not a shipped model): the
# abusive words that occur in the toxic-labelled documents weigh -3; a few
# mid-frequency filler fragments of the synthetic prose are named +1 / -1 so
# that every label of the scale occurs.
TEST_LEXICON = {
    "trash": -3, "clown": -3, "scum": -3, "idiot": -3, "worthless": -3,
    "moron": -3, "pathetic": -3, "loser": -3, "stupid": -3, "disgusting": -3,
    "tion": 1, "ble": 1, "ther": 1,
    "ing": -1, "ly": -1,
}

# Event phases for the phase comparison (half-open, UTC).
PHASES = [
    ("in_race", "2025-05-25T00:00:00", "2025-05-25T08:00:00"),
    ("post_race", "2025-05-25T08:00:00", "2025-05-27T00:00:00"),
]

# Sighting cut-off: earlier sightings form the ledger / the stored batch.
CUTOFF = "2024-01-03T00:00:00"


def prepare(spark: SparkSession) -> None:
    configure(spark)


def scorer() -> LexiconScorer:
    return LexiconScorer(TEST_LEXICON)


def comments(spark: SparkSession, sf: str) -> DataFrame:
    return TB.comment_rows(spark, sf)


def threads(spark: SparkSession, sf: str) -> DataFrame:
    posts, cs = TB.thread_rows(spark, sf)
    return nest_threads(posts, cs)


def labelled_comments(spark: SparkSession, sf: str) -> DataFrame:
    return score_comments(comments(spark, sf), scorer())


def labelled_threads(spark: SparkSession, sf: str) -> DataFrame:
    """Thread labels from flat rows: one sum per post, no nesting."""
    posts, cs = TB.thread_rows(spark, sf)
    return score_thread_rows(posts, cs, scorer())


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Both platforms' labelled items in one frame."""
    cols = ["content_id", "social_media", "publish_date", "user_location", "geo_location",
            "topic", "scope", "comment_raw_text", "sentiment", "ordinal", "defaulted"]
    return labelled_comments(spark, sf).select(*cols).unionByName(labelled_threads(spark, sf).select(*cols))


def label_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Every text of every item with its item's label, from flat rows."""
    cols = ["social_media", "content_id", "sentiment", "text"]
    lab = labelled_comments(spark, sf)
    own = lab.filter(has_text("comment_raw_text")).withColumn("text", F.col("comment_raw_text")).select(*cols)
    posts, cs = TB.thread_rows(spark, sf)
    labels = score_thread_rows(posts, cs, scorer()).select("social_media", "content_id", "sentiment")
    texts = thread_texts(posts, cs)
    return own.unionByName(texts.join(labels, texts["item_id"] == labels["content_id"]).select(*cols))


def iso(col) -> F.Column:
    from pulse.functions.time import iso_utc
    return iso_utc(col)
