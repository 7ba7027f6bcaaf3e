import glob
import re

from pulse.llm import decontam


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    wins = []
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        wins += [(item, tuple(w[i:i + n])) for i in range(len(w) - n + 1)] if n else []
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, win in wins:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    ids |= {str(item)} if item is not None else set()
        out.append((doc, len(w), len(hit), sorted(ids)))
    return sorted(out, key=str)


LONG = "one two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [(1, LONG), (2, "Alpha beta"), (3, "zap"), (4, None), (5, " .,;"), (None, "null item words"), (1, LONG), (7, "É the the the the the the the the the the"),
         (10, "Alpha beta"), (11, "a a a a a a a a a a a a")]
DOCS = [(1, f"x {LONG.upper()} y"), (2, LONG[:-9]), (3, "one two three four five six seven eight nine"), (4, None), (5, ""), (6, "alpha, BETA! alpha beta"),
        (7, "Zap zap zapp"), (8, "null item words here"), (9, "É " + "the " * 12), (9, "é " + "the " * 12), (9, "a " * 30), (None, f"{LONG} zap {LONG}"),
        (12, "ten eleven twelve thirteen " + LONG + " one two"), (1, f"x {LONG.upper()} y"), (13, "…".join(["alpha", "beta"]))]


def frames(spark):
    return (spark.createDataFrame([(*d, 1, "k") for d in DOCS], "doc_id long, text string, item_id int, key string"),
            spark.createDataFrame(ITEMS, "item_id long, text string"))


def test_hits_are_those_of_brute_force(spark):
    docs, items = frames(spark)
    lengths, hits = decontam.scan(docs, items)
    rows = lengths.join(hits, "key", "left").collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit or 0, r.ids or []) for r in rows), key=str)
    assert got == brute(DOCS, ITEMS)


def test_clean_documents_stay(spark):
    docs, items = frames(spark)
    clean = decontam.clean_documents(docs, items)
    assert clean.columns == docs.columns
    want = sorted((d for d, _, n, _ in brute(DOCS, ITEMS) if not n), key=str)
    assert sorted((r.doc_id for r in clean.collect()), key=str) == want


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert decontam.clean_documents(docs, items.limit(0)).count() == len(DOCS)
    assert decontam.clean_documents(docs.limit(0), items).count() == 0
    lengths, hits = decontam.scan(docs.limit(0), items)
    assert lengths.count() == 0 and hits.count() == 0


def test_proximity(spark):
    docs, items = frames(spark)
    near = spark.createDataFrame([(1, "alpha then beta"), (2, "beta alpha"), (3, "alpha x x x x x x x x beta")], "doc_id long, text string")
    table, entries, index = decontam.build_index(near, items)
    found = decontam.proximity_matches(index, entries, 2).join(index.where("term is null").select("key", "doc_id"), "key")
    assert sorted({r.doc_id for r in found.collect()}) == [1, 2]
    exact = decontam.proximity_matches(index, entries, 0)
    assert exact.count() == 0


def test_no_python_in_the_plans(spark):
    docs, items = frames(spark)
    lengths, hits = decontam.scan(docs, items)
    for frame in (decontam.postings(docs, items.selectExpr("item_id as term")), decontam.occurrences(docs, items.selectExpr("item_id as term"))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_words_are_those_of_the_pattern(spark):
    texts = [t for _, t in DOCS + ITEMS] + ["...", "a", " a", "a ", "\x00a\x7fb", "x_y-Z9", "É…é\u00a0ñ 日本 😀a", "a\n\n\tb\r", "`@[{aZ}]/:"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", decontam.raw_words(decontam.F.col("text")).alias("raw"), decontam.words_of(decontam.F.col("text")).alias("words")).collect()
    for r in rows:
        assert r.words == words(r.text)
        assert r.raw == re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r.text or "")


def test_text_keys_are_computed_once_a_document(spark):
    docs, items = frames(spark)
    plan = decontam.postings(docs, items.selectExpr("item_id as term"))._jdf.queryExecution().executedPlan().toString()
    assert 0 <= plan.rindex("Generate posexplode") < plan.index("md5(")


def test_wide_shuffles_do_not_scatter_small_tables(spark):
    docs, items = frames(spark)
    cores = spark.sparkContext.defaultParallelism
    wide = {"spark.sql.shuffle.partitions": str(4 * cores), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wide}
    many = spark.createDataFrame([(k, f"word{k} thing{k}") for k in range(20 * cores)], "item_id long, text string")
    try:
        for k, v in wide.items():
            spark.conf.set(k, v)
        table, entries, _ = decontam.build_index(docs, many)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for part in (table, entries):
        folder = part.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        assert len(glob.glob(f"{folder}/*.parquet")) <= cores
    assert table.count() == 20 * cores
