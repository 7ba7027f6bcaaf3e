"""T1 F4 F5 F7 P12 A1 A2 A8 A9 A13 D8 with the golden distributions."""

from pyspark.sql import functions as F

from conftest import rows
from pulse.functions.content import with_defaults
from pulse.operators import filters as FL
from pulse.operators import report as R
from pulse.operators.threads import item_texts, thread_text
from pulse.schema import COMMENT_STRUCT, LABELS


def _thread(spark, post, comments):
    cs = [tuple([f"c{i}"] + [None] * 6 + [t] + [None] * 8) for i, t in enumerate(comments)]
    schema = f"content_id string, comment_raw_text string, comments array<{COMMENT_STRUCT.simpleString()}>"
    return spark.createDataFrame([("t1", post, cs)], schema)


def test_thread_text(spark):
    df = _thread(spark, "p", ["c1", "  ", "c2"])
    assert df.select(thread_text()).first()[0] == "p commento:c1 commento:c2"
    blank = _thread(spark, " ", ["c1"])
    assert blank.select(thread_text()).first()[0] == " commento:c1"


def test_empty_thread_quarantined(spark):
    df = _thread(spark, "  ", []).withColumn("social_media", F.lit("Reddit")) \
        .withColumn("publish_date", F.current_timestamp())
    assert df.select(FL.quarantine_reason(df)).first()[0] == "blank_text"
    assert FL.drop_empty_threads(df).count() == 0


def test_null_and_absent_comments_are_empty(spark):
    df = spark.createDataFrame([("t1", "p", "Reddit")], "content_id string, comment_raw_text string, social_media string")
    absent = with_defaults(df, thread=True)
    nulls = with_defaults(df.withColumn("comments", F.lit(None).cast(f"array<{COMMENT_STRUCT.simpleString()}>")))
    assert absent.first()["comments"] == []
    assert nulls.first()["comments"] == []


def test_unknown_platform_and_malformed(spark):
    df = spark.createDataFrame([("a", "X", "t", None), (None, None, None, "{broken")],
                               "content_id string, social_media string, comment_raw_text string, _corrupt_record string")
    assert [r[0] for r in df.select(FL.quarantine_reason(df)).collect()] == ["unknown_platform", "malformed"]


def _labelled(spark, platform, counts):
    data = []
    for label, n in zip(LABELS, counts):
        data += [(platform, label, f"{platform}{label}{i}") for i in range(n)]
    return data


GOLDEN = {
    # (platform, counts VNeg..VPos) -> published shares
    ("Reddit in-race", (1, 9, 1, 4, 0)): {"Negative": 60.0, "Positive": 26.7, "Neutral": 6.7, "Very Negative": 6.7},
    ("Reddit post-race", (2, 12, 2, 7, 0)): {"Negative": 52.2, "Positive": 30.4, "Neutral": 8.7, "Very Negative": 8.7},
    ("YouTube in-race", (46, 23, 38, 19, 35)): {"Very Negative": 28.6, "Neutral": 23.6, "Very Positive": 21.7,
                                                "Negative": 14.3, "Positive": 11.8},
    ("YouTube post-race", (99, 54, 106, 55, 97)): {"Neutral": 25.8, "Very Negative": 24.1, "Very Positive": 23.6,
                                                   "Positive": 13.4, "Negative": 13.1},
}
DOMINANT = {"Reddit in-race": ("Negative", "Very Negative, Neutral"),
            "Reddit post-race": ("Negative", "Very Negative, Neutral"),
            "YouTube in-race": ("Very Negative", "Positive"),
            "YouTube post-race": ("Neutral", "Negative")}


def test_golden_distributions(spark):
    data = []
    for (name, counts) in GOLDEN:
        data += _labelled(spark, name, counts)
    df = spark.createDataFrame(data, "social_media string, sentiment string, content_id string")
    shares = R.label_share(df).collect()
    got = {}
    for r in shares:
        got.setdefault(r["social_media"], {})[r["sentiment"]] = r["share"]
    for (name, _), want in GOLDEN.items():
        assert got[name] == want, name
    dom = {r["social_media"]: (r["dominant"], r["least"]) for r in R.dominant_and_least(df).collect()}
    assert dom == DOMINANT
    ins = {r["social_media"]: r for r in R.distribution_insights(df).collect()}
    assert ins["Reddit in-race"]["absent"] == "Very Positive"
    assert ins["Reddit in-race"]["majority"] is True
    assert ins["YouTube post-race"]["both_extremes"] is True


def test_share_rounding_half_even(spark):
    df = spark.createDataFrame([("P", "Neutral", "a")] + [("P", "Negative", f"b{i}") for i in range(15)],
                               "social_media string, sentiment string, content_id string")
    got = {r["sentiment"]: r["share"] for r in R.label_share(df).collect()}
    assert got["Neutral"] == 6.2


def test_no_rows_no_report(spark):
    df = spark.createDataFrame([("YouTube", "Neutral", "a")], "social_media string, sentiment string, content_id string")
    assert [r[0] for r in R.render_summary(df).select("social_media").collect()] == ["YouTube"]


def test_texts_aligned_by_item(spark):
    t1 = _thread(spark, "p1", ["c1", "c2"]).withColumn("sentiment", F.lit("Positive")) \
        .withColumn("social_media", F.lit("Reddit"))
    t2 = _thread(spark, "p2", []).withColumn("content_id", F.lit("t2")) \
        .withColumn("sentiment", F.lit("Negative")).withColumn("social_media", F.lit("Reddit"))
    df = t1.unionByName(t2)
    got = rows(R.texts_by_label(df), "sentiment", "n_texts")
    assert got == [("Negative", 1), ("Positive", 3)]
    assert df.select(F.size(item_texts(df))).collect()[0][0] == 3


def test_normalize_thread_payload_row_local(spark):
    import json
    from pulse.sources.normalize import normalize_thread_payload
    post = {"id": "p1", "permalink": "/r/x/comments/p1/", "created_utc": 1748178000.0, "author": "a",
            "selftext": "hi https://x.y \U0001F600", "score": 3, "num_comments": 4, "rank": 1, "subreddit": "x"}
    comments = [
        {"id": "c3", "post_id": "p1", "parent_id": "p1", "position": 3, "created_utc": 1748178060.0,
         "author": "b", "body": "third", "score": 1},
        {"id": "c1", "post_id": "p1", "parent_id": "p1", "position": 1, "created_utc": 1748178030.0,
         "author": "b", "body": "first", "score": 1},
        {"id": "r1", "post_id": "p1", "parent_id": "c1", "position": 2, "created_utc": 1748178040.0,
         "author": "c", "body": "nested reply", "score": 1},
        {"id": "c4", "post_id": "p1", "parent_id": "p1", "position": 4, "created_utc": 1748178070.0,
         "author": "b", "body": "fourth", "score": 1},
    ]
    df = spark.createDataFrame([(json.dumps({"post": post, "comments": comments}),),
                                (json.dumps({"post": dict(post, id="p2"), "comments": None}),)], "payload string")
    out = {r["content_id"]: r for r in normalize_thread_payload(df, comment_limit=2).collect()}
    t = out["reddit_post_p1"]
    assert [c["content_id"] for c in t["comments"]] == ["reddit_comm_c1", "reddit_comm_c3"]
    assert t["comment_raw_text"] == "hi  \U0001F600" and t["emoji"] == ["\U0001F600"]
    assert t["comments"][0]["reference_post_url"] == "https://www.reddit.com/r/x/comments/p1/"
    assert out["reddit_post_p2"]["comments"] == []
