"""Hot keys: one post / platform / key holding most of the rows."""

from pyspark.sql import functions as F

from conftest import rows
from pulse.functions.content import user_or_none
from pulse.operators.report import item_series
from pulse.operators.threads import nest_parts, nest_threads
from pulse.schema import CONTENT_COLUMNS


def _comments(spark, n_hot, n_cold):
    data = [("hot", i) for i in range(n_hot)] + [(f"p{i}", 1) for i in range(n_cold)]
    df = spark.createDataFrame(data, "post_id string, position long").repartition(8)
    cols = [F.lit(None).cast("string").alias(c) for c in CONTENT_COLUMNS if c != "content_id"]
    return df.select("post_id", "position", F.concat("post_id", F.lit("_"), F.col("position").cast("string"))
                     .alias("content_id"), *cols)


def test_hot_post_nesting_is_bounded_and_exact(spark):
    comments = _comments(spark, 3000, 200)
    posts = spark.createDataFrame([("hot", "x")] + [(f"p{i}", "y") for i in range(200)],
                                  "content_id string, comment_raw_text string")
    out = nest_threads(posts, comments, 20)
    hot = out.filter("content_id = 'hot'").select(F.transform("comments", lambda c: c["content_id"])).first()[0]
    assert hot == [f"hot_{i}" for i in range(20)]
    assert out.filter(F.size("comments") == 1).count() == 200


def test_hot_post_is_nested_in_bounded_rows(spark):
    parts = nest_parts(_comments(spark, 3000, 20), 100).filter("post_id = 'hot'").orderBy("part").select(
        "part", F.transform("comments", lambda c: c["content_id"]).alias("ids")).collect()
    assert [(r.part, len(r.ids)) for r in parts] == [(i, 100) for i in range(30)]
    assert [i for r in parts for i in r.ids] == [f"hot_{i}" for i in range(3000)]


def test_big_threads_gathers_by_part(spark):
    from pulse.plans.catalogue import big_threads
    plan = big_threads(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    gathered = [x for x in plan.splitlines() if "collect_list" in x]
    assert gathered and all("_groupingexpression" in x or "/ 500" in x for x in gathered)


def test_series_with_one_dominant_platform(spark):
    data = [("A", i, f"a{i:05d}", "Neutral") for i in range(3000)] + [("B", i, f"b{i}", "Positive") for i in range(5)]
    df = spark.createDataFrame(data, "social_media string, t long, content_id string, sentiment string")
    from pulse.operators.sequence import number_rows
    multi = number_rows(df, ["social_media"], ["t", "content_id"], "item", num_partitions=8)
    assert rows(multi.filter("social_media = 'A'"), "content_id", "item") == [(f"a{i:05d}", i + 1) for i in range(3000)]
    s = item_series(df, ["t", "content_id"])
    got = rows(s.filter("social_media = 'A'"), "content_id", "item")
    assert got == [(f"a{i:05d}", i + 1) for i in range(3000)]
    assert rows(s.filter("social_media = 'B'"), "item") == [(i,) for i in range(1, 6)]


def test_user_or_none(spark):
    df = spark.createDataFrame([("bob",), (None,)], "u string")
    assert [r[0] for r in df.select(user_or_none("u")).collect()] == ["bob", "None"]


def test_nesting_in_parts_keeps_copies(spark):
    comments = _comments(spark, 30, 2)
    parts = nest_parts(comments.union(comments.filter("position = 3")), 10).filter("post_id = 'hot'").orderBy("part")
    ids = [i for r in parts.select(F.transform("comments", lambda c: c["content_id"]).alias("ids")).collect() for i in r.ids]
    assert ids == [f"hot_{i}" for i in range(30) for _ in range(2 if i == 3 else 1)]
