"""D1-D4, K1, L2, L5, order invariance, global numbering."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from pulse.operators import dedup as D
from pulse.operators import limits as L
from pulse.operators.sequence import number_rows

T0 = dt.datetime(2025, 5, 25, 13, 0, 0)


def test_keep_first_old_count_wins(spark):
    old = spark.createDataFrame([("c1", 5, 0)], "content_id string, like_count int, arrival int")
    new = spark.createDataFrame([("c1", 9, 1), ("c2", 3, 2), ("c2", 4, 3)], "content_id string, like_count int, arrival int")
    got = rows(D.union_keep_first(old, new, "content_id", ["arrival"]), "content_id", "like_count")
    assert got == [("c1", 5), ("c2", 3)]


def test_same_id_two_scopes(spark):
    ledger = spark.createDataFrame([("Reddit", "A", "x")], "social_media string, scope string, content_id string")
    items = spark.createDataFrame([("Reddit", "A", "x"), ("Reddit", "B", "x")], "social_media string, scope string, content_id string")
    assert rows(D.skip_seen(items, ledger), "scope") == [("B",)]
    assert rows(D.skip_seen(items, None), "scope") == [("A",), ("B",)]


def test_limit_before_seen(spark):
    items = spark.createDataFrame([("Reddit", "s", f"p{i}", i) for i in range(1, 6)],
                                  "social_media string, scope string, content_id string, rank int")
    ledger = items.filter("rank <= 2").select("social_media", "scope", "content_id")
    got = L.limit_then_skip_seen(items, 3, ledger, ["scope"], ["rank"])
    assert rows(got, "content_id") == [("p3",)]


def test_comment_limit_zero_keeps_post(spark):
    from pulse.operators.threads import nest_threads
    posts = spark.createDataFrame([("p1", "text")], "content_id string, comment_raw_text string")
    comments = spark.createDataFrame([], "content_id string, post_id string, position long")
    out = nest_threads(posts, comments.select("*", *[F.lit(None).cast("string").alias(c) for c in []]), 0)
    r = out.first()
    assert r["content_id"] == "p1" and r["comments"] == []


def test_dedup_without_key_column_unchanged(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    assert D.dedup_if_key(df, "content_id", ["a"]).count() == 2


def test_keep_first_is_order_invariant(spark):
    data = [(f"k{i % 7}", i, (i * 37) % 101) for i in range(300)]
    df = spark.createDataFrame(data, "k string, i int, v int")
    a = rows(D.dedup_first(df, "k", ["v", "i"]))
    b = rows(D.dedup_first(df.repartition(13).sortWithinPartitions(F.rand(1)), "k", ["v", "i"]))
    want = sorted({k: (k, i, v) for k, i, v in sorted(data, key=lambda x: (x[2], x[1]), reverse=True)}.values())
    assert a == b == want


def test_hot_key_keep_first(spark):
    # one key holds most rows: reduced map-side, result still exact
    data = [("hot", i) for i in range(2000)] + [(f"k{i}", i) for i in range(50)]
    df = spark.createDataFrame(data, "k string, i int").repartition(8)
    got = dict(rows(D.dedup_first(df, "k", ["i"])))
    assert got["hot"] == 0 and len(got) == 51


def test_number_rows_matches_row_number(spark):
    data = [("A" if i % 3 else "B", (i * 7919) % 1000, f"id{i}") for i in range(500)]
    df = spark.createDataFrame(data, "g string, t int, id string")
    got = rows(number_rows(df, ["g"], ["t", "id"], "item", num_partitions=8), "g", "id", "item")
    assert rows(number_rows(df, ["g"], ["t", "id"], "item"), "g", "id", "item") == got
    w = Window.partitionBy("g").orderBy("t", "id")
    want = rows(df.withColumn("item", F.row_number().over(w).cast("bigint")), "g", "id", "item")
    assert got == want


def test_top_n_and_nesting_order_invariant(spark):
    from pulse.operators.threads import nest_threads
    from pulse.schema import CONTENT_COLUMNS
    posts = spark.createDataFrame([(f"s{i % 3}", i, str(i)) for i in range(60)], "scope string, rank long, id string")
    a = rows(L.top_posts(posts, 4))
    b = rows(L.top_posts(posts.repartition(7).sortWithinPartitions(F.rand(3)), 4))
    assert a == b and len(a) == 12
    data = [(f"p{i % 5}", (i * 13) % 50, f"c{i}") for i in range(50)]
    cols = [F.lit(None).cast("string").alias(c) for c in CONTENT_COLUMNS if c != "content_id"]
    comments = spark.createDataFrame(data, "post_id string, position long, content_id string").select("*", *cols)
    p = spark.createDataFrame([(f"p{i}",) for i in range(5)], "content_id string")
    ids = lambda df: rows(df.select("content_id", F.transform("comments", lambda c: c["content_id"]).alias("ids")))
    x = ids(nest_threads(p, comments, 3))
    y = ids(nest_threads(p, comments.repartition(5).sortWithinPartitions(F.rand(7)), 3))
    assert x == y and all(len(r[1]) == 3 for r in x)
