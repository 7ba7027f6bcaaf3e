"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the inventory. Every query reads the driver tables whole.

Output conventions (so results compare 1:1 with the SQL oracle): instants as
ISO text with ``+00:00``, arrays joined with ``,``, every computed column
aliased.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions import labels as LB
from pulse.functions import text as X
from pulse.functions import time as TM
from pulse.operators import dedup as D
from pulse.operators import filters as FL
from pulse.operators import limits as L
from pulse.operators import report as R
from pulse.operators import terms as TR
from pulse.operators.sentiment import score_thread_rows, score_threads
from pulse.operators.threads import nest_parts, thread_text, thread_texts
from pulse.plans import common as CM
from pulse.schema import COMMENTS_PER_POST, COMMENTS_PER_VIDEO, POSTS_PER_RUN, THREAD_SEPARATOR
from pulse.sources import normalize as N
from pulse.sources import tables as TB

iso = CM.iso


# ------------------------------------------------------------ normalisation
def normalize_thread_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Thread payload -> flat CONTENT rows."""
    CM.prepare(spark)
    posts, comments = TB.thread_rows(spark, sf)
    flat = N.flatten_threads(posts, comments)
    return flat.select(
        "content_id", iso("observation_time").alias("observation_time"), "user",
        "user_location", "social_media", iso("publish_date").alias("publish_date"),
        "geo_location", "comment_raw_text", X.emoji_csv("emoji").alias("emoji"),
        "reference_post_url", "like_count", "reply_count", "repost_count", "quote_count",
        "bookmark_count", "content_type", "topic", "scope")


def normalize_comment_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Landed JSON comment pages -> CONTENT rows."""
    CM.prepare(spark)
    rows = N.normalize_comment_pages(TB.comment_pages(spark, sf), "payload", TB.OBSERVED_AT)
    return rows.select(
        "content_id", iso("observation_time").alias("observation_time"), "user",
        "social_media", iso("publish_date").alias("publish_date"), "comment_raw_text",
        X.emoji_csv("emoji").alias("emoji"), "reference_post_url", "like_count",
        "reply_count", "content_type", "topic", "scope")


def iso_times(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch -> UTC text, strict parse of platform text, run instant."""
    CM.prepare(spark)
    ev = TB.table(spark, sf, "events")
    epoch = F.unix_micros(F.col("ts").cast("timestamp")).cast("double") / 1_000_000
    platform_text = F.date_format(F.col("ts").cast("timestamp"), TM.PLATFORM_FORMAT)
    return ev.select(
        "event_id",
        iso(TM.epoch_to_utc(epoch)).alias("from_epoch"),
        platform_text.alias("platform_text"),
        iso(TM.parse_utc(platform_text)).alias("parsed"),
        iso(TM.parse_utc(F.col("event_type"))).alias("bad_parse"),
        iso(TM.observed_at(TB.OBSERVED_AT)).alias("observation_time"))


# ------------------------------------------------------------ text cleaning
def clean_thread_text(spark: SparkSession, sf: str) -> DataFrame:
    """P6 over conversation turns and raw web pages."""
    CM.prepare(spark)
    conv = TB.table(spark, sf, "conversations").select(
        F.lit("conversation").alias("kind"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.col("text").alias("raw"))
    pages = TB.table(spark, sf, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("raw"))
    both = conv.unionByName(pages)
    return both.select("kind", "id", X.clean_thread_text("raw").alias("cleaned"),
                       F.length(X.clean_thread_text("raw")).alias("n_chars"))


def clean_comment_text(spark: SparkSession, sf: str) -> DataFrame:
    """P7 P13 over comment texts and raw web pages, with a 100-char preview."""
    CM.prepare(spark)
    docs = TB.table(spark, sf, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("raw"))
    pages = TB.table(spark, sf, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("raw"))
    cleaned = docs.unionByName(pages).withColumn("cleaned", X.clean_comment_text("raw"))
    return cleaned.select("kind", "id", "cleaned", X.preview("cleaned", 100).alias("preview"),
                          F.length("cleaned").alias("n_chars"))


# Emoji appended to comment texts (the tables hold none): the pick is by
# doc_id so every variant occurs; all rows are processed.
EMOJI_SUFFIXES = [
    " 😀 ok 👍🏽 😀",
    " ❤️ and 👨‍👩‍👧 at https://x.y/😀",
    " 🇮🇹 1️⃣ 🇮🇹",
    "",
]


def distinct_emoji(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct emoji (first-appearance order) of raw and cleaned text."""
    CM.prepare(spark)
    docs = TB.table(spark, sf, "documents")
    pick = F.pmod(F.col("doc_id"), F.lit(len(EMOJI_SUFFIXES)))
    suffix = F.element_at(F.array(*[F.lit(s) for s in EMOJI_SUFFIXES]), (pick + 1).cast("int"))
    raw = F.concat(F.col("text"), suffix)
    return docs.select(
        "doc_id",
        X.distinct_emoji(raw).alias("raw"), X.distinct_emoji(X.clean_comment_text(raw)).alias("cleaned")
    ).select("doc_id", X.emoji_csv("raw").alias("emoji_raw"), X.emoji_csv("cleaned").alias("emoji_cleaned"),
             F.size("raw").alias("n_emoji"))


# ------------------------------------------------------------------ filters
def platform_topic_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Requested known platforms (unknown names skipped), one topic
    for comments, and the known-platform predicate over the mixed rows."""
    CM.prepare(spark)
    posts, comments = TB.thread_rows(spark, sf)
    mixed = N.flatten_threads(posts, comments).unionByName(CM.comments(spark, sf))
    picked, _rejected = FL.select_platforms(mixed, ["YouTube", "Reddit", "Mastodon"])
    en = FL.topic_scope(picked.filter(F.col("social_media") == "YouTube"), topic="en")
    threads_user = FL.topic_scope(picked.filter(F.col("social_media") == "Reddit"), scope="user")
    return en.unionByName(threads_user).filter(FL.known_platform()).select(
        "content_id", "social_media", "topic", "scope")


# Injected faults for the quarantine query: derived from each thread's own
# content, so every thread is still read and tagged.
def _faulty_threads(spark: SparkSession, sf: str) -> DataFrame:
    t = CM.threads(spark, sf).withColumn("_n", F.length(F.col("comment_raw_text")))
    n = F.col("_n")
    platform = F.when(n % 7 == 0, F.lit("Mastodon")).otherwise(F.col("social_media"))
    post = F.when(n % 5 == 0, F.lit("  \n")).otherwise(F.col("comment_raw_text"))
    blank_comments = F.transform("comments", lambda c: c.withField("comment_raw_text", F.lit(" ")))
    cs = F.when(n % 3 == 0, blank_comments).when(n % 11 == 0, F.lit(None)).otherwise(F.col("comments"))
    when_ = F.when(n % 13 == 0, F.lit(None)).otherwise(F.col("publish_date"))
    return (t.withColumn("social_media", platform).withColumn("comment_raw_text", post)
            .withColumn("comments", cs).withColumn("publish_date", when_).drop("_n"))


def quarantine_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Reason per thread document (null = accepted)."""
    CM.prepare(spark)
    docs = _faulty_threads(spark, sf)
    tagged = docs.withColumn("reason", FL.quarantine_reason(docs))
    return tagged.select("content_id", "social_media", "reason",
                         F.size(FL.drop_blank_comments(F.coalesce("comments", F.array()))).alias("n_text_comments"))


def top_level_comments(spark: SparkSession, sf: str) -> DataFrame:
    """F8: replies to replies are dropped, only answers to the post stay."""
    CM.prepare(spark)
    raw_posts, raw_comments = TB.raw_thread_payload(spark, sf, reply_chain=True)
    rows = N.normalize_comments(N.top_level_only(raw_comments), raw_posts, TB.OBSERVED_AT)
    return rows.select("content_id", "post_id", "position", "scope", "reference_post_url")


# ------------------------------------------------------------------- limits
def top_items_per_scope(spark: SparkSession, sf: str) -> DataFrame:
    """L1 L3: first posts per community, first hits per topic."""
    CM.prepare(spark)
    raw_posts, _ = TB.raw_thread_payload(spark, sf)
    posts = raw_posts.withColumn("scope", F.col("subreddit"))
    tp = L.top_posts(posts, POSTS_PER_RUN, "rank_in_scope").select(
        F.lit("post").alias("kind"), "scope", F.concat(F.lit("reddit_post_"), F.col("id")).alias("item"),
        "rank_in_scope")
    tv = L.top_videos(TB.search_hits(spark, sf), 3, "rank_in_scope").select(
        F.lit("video").alias("kind"), F.col("topic").alias("scope"), F.col("scope").alias("item"),
        "rank_in_scope")
    return tp.unionByName(tv)


def top_comments_per_thread(spark: SparkSession, sf: str) -> DataFrame:
    """L2 L4: first comments per post (20) and, in listing order (page, place in
    the page, which is not the order of times), per video (25)."""
    CM.prepare(spark)
    _posts, comments = TB.thread_rows(spark, sf)
    a = L.top_comments(comments, COMMENTS_PER_POST, "pos").select(
        F.col("post_id").alias("parent"), "content_id", "pos")
    pages = TB.listed_comment_pages(spark, sf)
    vids = N.normalize_comment_pages(pages, "payload", TB.OBSERVED_AT, keep=["page"])
    b = L.top_video_comments(vids, COMMENTS_PER_VIDEO, ["page", "position", "content_id"], "pos").select(
        F.col("scope").alias("parent"), "content_id", "pos")
    return a.unionByName(b)


def limit_then_skip_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Take the first 10 sightings per scope after the cut-off, then
    drop those already in the ledger (sightings before the cut-off)."""
    CM.prepare(spark)
    obs = TB.observations(spark, sf)
    cut = F.to_timestamp(F.lit(CM.CUTOFF))
    ledger = D.ledger_entries(obs.filter(F.col("arrival_ts") < cut))
    new = obs.filter(F.col("arrival_ts") >= cut)
    out = L.limit_then_skip_seen(new, POSTS_PER_RUN, ledger, ["scope"], ["arrival_ts", "event_id"])
    return out.select("scope", "content_id", "event_id")


def preview_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Five-row preview and (rows, columns) of the comment table."""
    CM.prepare(spark)
    rows = CM.comments(spark, sf)
    head = L.head_and_shape(rows, ["publish_date", "content_id"], 5)
    return head.select("content_id", X.preview("comment_raw_text", 100).alias("preview"),
                       "n_rows", "n_cols")


# -------------------------------------------------------------------- dedup
def skip_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Sightings after the cut-off whose (scope, item) is new, and the
    ledger entries they add."""
    CM.prepare(spark)
    obs = TB.observations(spark, sf)
    cut = F.to_timestamp(F.lit(CM.CUTOFF))
    ledger = D.ledger_entries(obs.filter(F.col("arrival_ts") < cut))
    fresh = D.skip_seen(obs.filter(F.col("arrival_ts") >= cut), ledger)
    added = D.ledger_entries(fresh)
    return added.select("social_media", "scope", "content_id")


def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    """First sighting per (scope, item) wins."""
    CM.prepare(spark)
    obs = TB.observations(spark, sf)
    first = D.dedup_first(obs, ["scope", "content_id"], ["arrival_ts", "event_id"])
    same = D.dedup_if_key(obs.drop("content_id"), "content_id", ["event_id"])
    n_without_key = same.select(F.count(F.lit(1))).scalar()
    return first.select("scope", "content_id", "event_id", "value",
                        iso("arrival_ts").alias("first_seen"),
                        n_without_key.alias("rows_without_key"))


# Texts that a CSV file can easily change.
CSV_NOTES = [" a ", " ", "", 'q"u,o', "two\nlines", None, "\\N x", "\ttab"]


def upsert_first(spark: SparkSession, sf: str) -> DataFrame:
    """A Parquet dataset grows by the new keys of each batch (the
    second batch holds earlier times, and what is stored stays), is exported as a
    topic CSV and read back without loss."""
    from pulse.session import scratch_path
    from pulse.sinks.files import write_topic
    from pulse.sources.files import read_topic_csv
    from pulse.streaming.jobs import append_new
    CM.prepare(spark)
    obs = TB.observations(spark, sf).select(
        "content_id", "scope", "social_media", "arrival_ts", "event_id", "value")
    obs = obs.withColumn("note", F.element_at(F.array(*[F.lit(x) for x in CSV_NOTES]), (F.pmod("event_id", F.lit(len(CSV_NOTES))) + 1).cast("int")))
    cut = F.to_timestamp(F.lit(CM.CUTOFF))
    dataset, export = scratch_path(spark, "topic"), scratch_path(spark, "topic_csv")
    for batch in (obs.filter(F.col("arrival_ts") >= cut), obs.filter(F.col("arrival_ts") < cut)):
        append_new(batch, dataset, ["content_id"], ["arrival_ts", "event_id"])
    stored = spark.read.parquet(dataset)
    write_topic(stored, export)
    back = read_topic_csv(spark, export, stored.schema)
    missing = read_topic_csv(spark, export + "_absent", stored.schema)
    return back.select("content_id", "scope", iso("arrival_ts").alias("first_seen"), "event_id", "note",
                       missing.select(F.count(F.lit(1))).scalar().alias("rows_in_missing"))


# ------------------------------------------------------------------ threads
def nest_threads_q(spark: SparkSession, sf: str) -> DataFrame:
    """Per thread document: comment count, first/last comment, ids."""
    CM.prepare(spark)
    t = CM.threads(spark, sf)
    ids = F.transform("comments", lambda c: c.getField("content_id"))
    return t.select("content_id", F.size("comments").alias("n_comments"),
                    F.try_element_at(ids, F.lit(1)).alias("first_comment"),
                    F.try_element_at(ids, F.lit(-1)).alias("last_comment"),
                    F.array_join(ids, ",").alias("comment_ids"))


def thread_text_q(spark: SparkSession, sf: str) -> DataFrame:
    """The glued thread text."""
    CM.prepare(spark)
    t = CM.threads(spark, sf)
    glued = thread_text()
    return t.select("content_id", glued.alias("thread_text"), F.length(glued).alias("n_chars"))


# ---------------------------------------------------------------- sentiment
def comment_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """T2(a) T5 T6: lexicon label per comment over its whole text; the
    token count and whether a 512-token model window would cut it."""
    CM.prepare(spark)
    lab = CM.labelled_comments(spark, sf)
    n_tok = F.size(X.tokens("comment_raw_text"))
    return lab.select("content_id", "score", "ordinal", "sentiment", "defaulted",
                      n_tok.alias("n_tokens"),
                      (n_tok > F.size(X.truncate_tokens(X.tokens("comment_raw_text")))).alias("over_cap"),
                      LB.label_to_ordinal(F.col("sentiment")).alias("ordinal_check"))


def thread_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Lexicon label per thread, from flat rows; the length of the
    glued text is the sum of its parts'."""
    CM.prepare(spark)
    posts, cs = TB.thread_rows(spark, sf)
    part = F.length("text") + F.when(F.col("is_post"), 0).otherwise(len(THREAD_SEPARATOR))
    chars = thread_texts(posts, cs).groupBy("item_id").agg(F.sum(part).alias("n_chars"))
    lab = CM.labelled_threads(spark, sf)
    return lab.join(chars, lab["content_id"] == chars["item_id"], "left").select(
        "content_id", "score", "ordinal", "sentiment", "defaulted",
        F.coalesce("n_chars", F.lit(0)).cast("int").alias("n_chars"))


def big_threads(spark: SparkSession, sf: str) -> DataFrame:
    """D6 T1 T3 without a cap: every document source is a thread (its first
    document the post, all others the comments), so threads have hundreds of
    comments or, for a hot source, a large share of all rows; nested in parts,
    glued and labelled by part, and labelled from flat rows."""
    CM.prepare(spark)
    posts, cs = TB.source_threads(spark, sf)
    flat = score_thread_rows(posts, cs, CM.scorer()).select("content_id", F.col("score").alias("flat_score"), "sentiment")
    parts = nest_parts(cs).select(F.col("post_id").alias("content_id"), F.lit("").alias("comment_raw_text"), "comments")
    heads = posts.select("content_id", "comment_raw_text", F.array().cast(parts.schema["comments"].dataType).alias("comments"))
    # a part begins with the separator, so lengths and scores of the parts add up
    documents = score_threads(heads.unionByName(parts), CM.scorer()).groupBy("content_id").agg(
        F.sum(F.size("comments")).cast("int").alias("n_comments"), F.sum(F.length("thread_text")).cast("int").alias("n_chars"),
        F.sum("score").alias("score"))
    return documents.join(flat, "content_id")


def _lexicon_model(texts):
    """A plug-in model written in pandas (fixture): the test lexicon's rule,
    token by token, with the ``regex`` module's Unicode classes."""
    import pandas as pd
    import regex
    token = regex.compile(X.TOKEN)
    weights = CM.TEST_LEXICON

    def one(text: str) -> int:
        score = sum(weights.get(t, 0) for t in token.findall(text.lower()))
        return min(max(score, -2), 2) + 2

    return pd.Series([one(t) for t in texts], index=texts.index)


def plugin_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """T2(c): a caller-supplied pandas scorer applied with Arrow batches."""
    from pulse.operators.sentiment import PandasScorer
    CM.prepare(spark)
    out = PandasScorer(_lexicon_model).label(CM.comments(spark, sf), "comment_raw_text")
    return out.select("content_id", "ordinal", "sentiment", "defaulted")


# Free-text model answers, picked per benchmark item by item_id.
ANSWERS = [
    "Very Positive",
    "The sentiment is Negative.",
    "very positive",
    "none of these",
    "Positive, but not Very Negative",
    "Neutral",
    "Very Negative!",
]


def extract_label(spark: SparkSession, sf: str) -> DataFrame:
    """T4: parse an answer in both modes."""
    CM.prepare(spark)
    b = TB.table(spark, sf, "benchmark")
    pick = (F.pmod(F.col("item_id"), F.lit(len(ANSWERS))) + 1).cast("int")
    answer = F.element_at(F.array(*[F.lit(a) for a in ANSWERS]), pick)
    return b.select("item_id", answer.alias("answer"),
                    LB.extract_label(answer, "longest").alias("label_longest"),
                    LB.extract_label(answer, "scale_order").alias("label_scale_order"),
                    LB.label_to_ordinal(LB.extract_label(answer, "longest")).alias("ordinal"))


def trained_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """T2(b): multinomial logistic regression trained on labelled documents
    (toxic -> Very Negative, low quality -> Neutral, quality -> Positive),
    applied to every comment."""
    from pulse.operators.sentiment import TrainedScorer
    CM.prepare(spark)
    rows = CM.comments(spark, sf)
    labels = TB.table(spark, sf, "labels").select(
        F.concat(F.lit("yt_comm_"), F.col("doc_id").cast("string")).alias("content_id"),
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 2).otherwise(3).alias("target"))
    train = rows.join(labels, "content_id")
    model = TrainedScorer(num_features=1 << 14, max_iter=30).fit(train, "comment_raw_text", "target")
    out = model.label(rows, "comment_raw_text")
    return out.select("content_id", "ordinal", "sentiment", "defaulted")


def trained_sentiment_rules(spark: SparkSession, sf: str) -> DataFrame:
    """T2(b) T5: what is exact about the trained labels: one per comment, Neutral
    and flagged where there is no text, the name of its ordinal, and a class that
    the training rows have."""
    out = trained_sentiment(spark, sf)
    return out.select("content_id", "defaulted",
                      (F.col("sentiment") == LB.ordinal_to_label(F.col("ordinal"))).alias("label_of_ordinal"),
                      F.col("ordinal").isin(0, 2, 3).alias("trained_class"))


# ------------------------------------------------------------------ reports
def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Label counts per platform."""
    CM.prepare(spark)
    return R.label_counts(CM.labelled(spark, sf)).select("social_media", "sentiment", "n")


def label_share(spark: SparkSession, sf: str) -> DataFrame:
    """A2: share per label per platform (one decimal, half-even)."""
    CM.prepare(spark)
    return R.label_share(CM.labelled(spark, sf)).select(
        "social_media", "sentiment", "ordinal", "n", "total", "share")


def item_series(spark: SparkSession, sf: str) -> DataFrame:
    """A3: Item 1..n per platform in publish order, with ordinal and colour."""
    CM.prepare(spark)
    s = R.item_series(CM.labelled(spark, sf), ["publish_date", "content_id"])
    return s.select("social_media", "item", "item_label", "content_id", "sentiment", "ordinal", "colour")


def texts_by_label(spark: SparkSession, sf: str) -> DataFrame:
    """Texts per label, paired by item."""
    CM.prepare(spark)
    return R.texts_by_label(CM.label_texts(spark, sf)).select(
        "social_media", "sentiment", "ordinal", "n_items", "n_texts", "text_chars", "joined_chars")


def terms_by_label(spark: SparkSession, sf: str) -> DataFrame:
    """Top 200 terms per platform and label, stop-words removed."""
    CM.prepare(spark)
    return TR.term_frequency(CM.label_texts(spark, sf), ["social_media", "sentiment"]).select(
        "social_media", "sentiment", "term", "n", "rank", "weight")


def collocations_by_label(spark: SparkSession, sf: str) -> DataFrame:
    """Collocations (LLR > 30) per platform and label."""
    CM.prepare(spark)
    c = TR.collocations(CM.label_texts(spark, sf), ["social_media", "sentiment"])
    return c.select("social_media", "sentiment", "w1", "w2", "c12", "c1", "c2", "n_words",
                    F.round("llr", 6).alias("llr"))


def cloud_by_label(spark: SparkSession, sf: str) -> DataFrame:
    """One ranked list of at most 200 words and phrases per platform and
    label: elected spellings, plurals merged, phrases' counts taken off their words."""
    CM.prepare(spark)
    return TR.cloud_list(CM.label_texts(spark, sf), ["social_media", "sentiment"]).select(
        "social_media", "sentiment", "rank", "entry", "is_phrase", "n", "weight")


def dominant_least(spark: SparkSession, sf: str) -> DataFrame:
    """Most and least common label per platform, ties listed together."""
    CM.prepare(spark)
    return R.dominant_and_least(CM.labelled(spark, sf)).select(
        "social_media", "dominant", "dominant_share", "least", "least_share", "total")


def distribution_insights(spark: SparkSession, sf: str) -> DataFrame:
    """Peak, absent labels, extremes."""
    CM.prepare(spark)
    return R.distribution_insights(CM.labelled(spark, sf))


def summary_text(spark: SparkSession, sf: str) -> DataFrame:
    """A10: deterministic four-part summary per platform."""
    CM.prepare(spark)
    return R.render_summary(CM.labelled(spark, sf))


def compare_phases(spark: SparkSession, sf: str) -> DataFrame:
    """Label shares in the two event phases and their change."""
    CM.prepare(spark)
    return R.compare_phases(CM.labelled(spark, sf), CM.PHASES).select(
        "social_media", "sentiment", "share_in_race", "share_post_race", "delta")


def phase_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Label shares per phase of a table of overlapping phases (every fifth
    comment opens one, for as many seconds as its text has characters)."""
    CM.prepare(spark)
    docs = TB.table(spark, sf, "documents").where("doc_id % 5 = 0")
    opened = F.col("doc_id") * TB.COMMENT_SPACING_S + TB.ORIGIN_EPOCH
    phases = docs.select(F.concat(F.lit("phase_"), F.col("doc_id").cast("string")).alias("phase"), F.timestamp_seconds(opened).alias("start"),
                         F.timestamp_seconds(opened + F.col("n_chars")).alias("end"), F.col("doc_id").alias("rank"))
    return R.phase_shares(CM.labelled(spark, sf), phases)


def cycle_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Sightings per scope per daily run."""
    CM.prepare(spark)
    return R.cycle_metrics(TB.observations(spark, sf), "arrival_ts", "1 day")


def sentiment_over_time(spark: SparkSession, sf: str) -> DataFrame:
    """Label counts per hour of publish time."""
    CM.prepare(spark)
    return R.sentiment_over_time(CM.labelled(spark, sf), "1 hour")


def sentiment_by_place(spark: SparkSession, sf: str) -> DataFrame:
    """Label counts per place (comment language stands for the place)."""
    CM.prepare(spark)
    lab = CM.labelled(spark, sf).withColumn(
        "user_location", F.when(F.col("social_media") == "YouTube", F.col("topic")))
    return R.sentiment_by_place(lab)


QUERIES = {
    "normalize_thread_rows": normalize_thread_rows,
    "normalize_comment_payload": normalize_comment_payload,
    "iso_times": iso_times,
    "clean_thread_text": clean_thread_text,
    "clean_comment_text": clean_comment_text,
    "distinct_emoji": distinct_emoji,
    "platform_topic_filter": platform_topic_filter,
    "quarantine_reasons": quarantine_reasons,
    "top_level_comments": top_level_comments,
    "top_items_per_scope": top_items_per_scope,
    "top_comments_per_thread": top_comments_per_thread,
    "limit_then_skip_seen": limit_then_skip_seen,
    "preview_shape": preview_shape,
    "skip_seen": skip_seen,
    "dedup_first": dedup_first,
    "upsert_first": upsert_first,
    "nest_threads": nest_threads_q,
    "thread_text": thread_text_q,
    "big_threads": big_threads,
    "comment_sentiment": comment_sentiment,
    "thread_sentiment": thread_sentiment,
    "trained_sentiment": trained_sentiment,
    "trained_sentiment_rules": trained_sentiment_rules,
    "plugin_sentiment": plugin_sentiment,
    "extract_label": extract_label,
    "label_counts": label_counts,
    "label_share": label_share,
    "item_series": item_series,
    "texts_by_label": texts_by_label,
    "terms_by_label": terms_by_label,
    "collocations_by_label": collocations_by_label,
    "cloud_by_label": cloud_by_label,
    "dominant_least": dominant_least,
    "distribution_insights": distribution_insights,
    "summary_text": summary_text,
    "compare_phases": compare_phases,
    "phase_shares": phase_shares,
    "cycle_metrics": cycle_metrics,
    "sentiment_over_time": sentiment_over_time,
    "sentiment_by_place": sentiment_by_place,
}
