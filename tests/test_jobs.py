"""End-to-end batch cycles: collect -> stage -> label -> report; a re-run adds nothing."""

from pyspark.sql import functions as F

from pulse.plans import common as CM
from pulse.plans import jobs as JB
from pulse.session import scratch_path
from pulse.sources import tables as TB
from pulse.streaming.catalogue import _label_comments, _label_threads

SF = "/root/testdata/sf0.001"


def test_thread_and_comment_cycles(spark):
    base = scratch_path(spark, "cycle")
    raw_posts, raw_comments = TB.raw_thread_payload(spark, SF)
    first = JB.collect_threads(spark, raw_posts, raw_comments, f"{base}/ledger", f"{base}/staged_t",
                               None, f"{base}/topic_v1", observed_at=TB.OBSERVED_AT)
    n_posts = first.filter(F.col("content_type") == "post").count()
    scopes = raw_posts.select("subreddit").distinct().count()
    assert 0 < n_posts <= 10 * scopes
    # the same feed again: every top post is already seen, nothing is staged or added
    again = JB.collect_threads(spark, raw_posts, raw_comments, f"{base}/ledger", f"{base}/staged_t",
                               f"{base}/topic_v1", f"{base}/topic_v2", observed_at=TB.OBSERVED_AT)
    assert again.count() == 0
    assert spark.read.json(f"{base}/staged_t").count() == n_posts
    v1 = spark.read.option("header", True).csv(f"{base}/topic_v1").count()
    v2 = spark.read.option("header", True).csv(f"{base}/topic_v2").count()
    assert v1 == v2 == first.count()

    pages = TB.comment_pages(spark, SF)
    hits = TB.search_hits(spark, SF)
    got = JB.collect_comments(spark, pages, f"{base}/ledger", f"{base}/staged_c", None,
                              f"{base}/ctopic_v1", observed_at=TB.OBSERVED_AT, hits=hits, rejects=f"{base}/rejects")
    picked = {r[0] for r in got.select("topic", "scope").distinct().groupBy("topic").count().select("count").collect()}
    assert picked == {3}
    assert 0 < got.count() <= 3 * 25 * pages.select(F.get_json_object("payload", "$.query")).distinct().count()
    assert JB.collect_comments(spark, pages, f"{base}/ledger", f"{base}/staged_c", f"{base}/ctopic_v1",
                               f"{base}/ctopic_v2", observed_at=TB.OBSERVED_AT, hits=hits).count() == 0

    JB.label_staged(spark, f"{base}/staged_t", f"{base}/staged_c", f"{base}/store", _label_threads, _label_comments)
    JB.label_staged(spark, f"{base}/staged_t", f"{base}/staged_c", f"{base}/store", _label_threads, _label_comments)
    store = spark.read.parquet(f"{base}/store")
    assert store.count() == n_posts + got.count()
    shares = JB.report(spark, f"{base}/store")["label_share"].collect()
    assert {r["social_media"] for r in shares} == {"Reddit", "YouTube"}
    assert abs(sum(r["share"] for r in shares if r["social_media"] == "Reddit") - 100) < 0.5
