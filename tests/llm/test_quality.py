import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from pulse.llm import quality

from odd import no_docs, odd_docs  # noqa: F401


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    tri = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if tri[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit),
            len(words) < 50 or 100 * len(hit) > 50 * len(words))


def test_measures_are_those_of_the_text(spark, odd_docs):
    more = ["a a a a", "a b c a b c", "x y z\nx y z\nq", "#*$ %&|<> ok", "a\x0bb\x0cc\rd", "é é é é é", " \n \n", "w " * 60, "1 2 3 1 2 4 1 2 3 5 1 2 3"]
    docs = odd_docs.select("doc_id", "text", "lang").union(spark.createDataFrame([(99, t, "xx") for t in more], "doc_id long, text string, lang string"))
    rows = quality.measured(docs, "m").select("text", "m.*").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text), r.text


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10, .1), (1, 10, .3), (3, 50, .2), (0, 5000, .002), (4, 5000, .002), (90, 1000, .1), (9, 100, .1), (10, 100, .1), (0, 1, .5)]
    for k, n, p in cases:
        got = spark.range(1).select(quality.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
        want = 1.0 if k >= n * p else sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(got, want, rel_tol=1e-9), (k, n, p)


def test_cutoffs_hold_the_risk(spark):
    """Junk is cut, a stratum with few labels takes the cutoffs tested on all, good rows stay."""
    rows = []
    for i in range(6000):
        rows.append((i, "en", 0.9 if i % 10 == 0 else 0.0))
    rows += [(10_000 + i, "de", 0.9 if i % 2 else 0.0) for i in range(20)] + [(20_000, "xx", 0.9)]
    frame = spark.createDataFrame(rows, "doc_id long, stratum string, symbol_ratio double").withColumn("base_failed", F.lit(False))
    labels = spark.createDataFrame([(r[0], int(r[2] == 0)) for r in rows[:-1]] + [(None, 1), (3, None), (77_777, 0)], "doc_id long, quality int")
    grid = {"symbol_ratio": [2.0, 0.5, 0.1]}
    cuts = quality.calibrate(frame, labels, alpha=0.01, delta=0.05, grid=grid).collect()
    assert sorted((r.stratum, r.cut_symbol_ratio) for r in cuts) == [("de", 0.5), ("en", 0.5)]
    # good rows above the cutoff: beyond the risk nothing may be chosen
    noisy = labels.where("doc_id is not null and quality is not null").select("doc_id", F.when(F.col("doc_id") % 50 == 0, 1).otherwise(F.col("quality")).alias("quality"))
    assert quality.calibrate(frame, noisy, alpha=0.01, delta=0.05, grid=grid).count() == 0


def chosen_vectors(rows, alpha, delta, grid):
    """The method on lists of (stratum, good, {rule: ratio}), written out."""
    order = quality.steps_of(grid)
    strata = sorted({s for s, _, _ in rows})
    good = {s: sum(g for t, g, _ in rows if t == s) for s in strata}
    alone = [s for s in strata if (1 - alpha) ** good[s] <= delta / len(strata)]
    tests = {s: [x for x in rows if x[0] == s] for s in alone}
    if len(alone) < len(strata):
        tests[None] = rows
    best = {}
    for key, own in tests.items():
        vector, n = {}, sum(g for _, g, _ in own)
        for rule, cut in order:
            vector[rule] = cut
            out = [g for _, g, x in own if any(x[r] > c for r, c in vector.items())]
            k, caught = sum(out), len(out) - sum(out)
            tail = 1.0 if k >= n * alpha else sum(math.comb(n, i) * alpha ** i * (1 - alpha) ** (n - i) for i in range(k + 1))
            if tail > delta / len(tests):
                break
            if caught > best.get(key, (0, None))[0]:
                best[key] = (caught, dict(vector))
    return {s: best[s if s in alone else None][1] for s in strata if (s if s in alone else None) in best}


def test_joint_risk_against_the_method_written_out(spark):
    grid = {"symbol_ratio": [2.0, 0.5, 0.1], "word_length": [9.0, 7.0], "bang_ratio": [1.0, 0.3]}
    assert quality.steps_of(grid)[:3] == [("symbol_ratio", 2.0), ("bang_ratio", 1.0), ("symbol_ratio", 0.5)]
    assert [r for r, _ in quality.steps_of(grid)[-2:]] == ["word_length"] * 2
    for seed, leak in ((1, 0.0), (2, 0.004), (3, 0.02)):
        draw = random.Random(seed)
        rows = []
        for s, n in (("a", 900), ("b", 500), ("c", 90), ("d", 20)):
            for _ in range(n):
                ok = draw.random() < 0.9
                junk = draw.random() < (leak if ok else 0.8)
                rows.append((s, ok, {"symbol_ratio": draw.choice([0.3, 0.7, 3.0]) if junk else 0.01,
                                     "bang_ratio": 0.4 * draw.random() if ok else draw.random(), "word_length": 5 + 3 * draw.random()}))
        frame = spark.createDataFrame([(i, s, False, *[x[r] for r in grid]) for i, (s, _, x) in enumerate(rows)],
                                      "doc_id long, stratum string, base_failed boolean, " + ", ".join(f"{r} double" for r in grid))
        labels = spark.createDataFrame([(i, int(g)) for i, (_, g, _) in enumerate(rows)], "doc_id long, quality int")
        got = {r.stratum: {q: r[f"cut_{q}"] for q in grid if r[f"cut_{q}"] is not None}
               for r in quality.calibrate(frame, labels, 0.01, 0.05, grid).collect()}
        assert got == chosen_vectors(rows, 0.01, 0.05, grid), seed
        assert got or leak > 0.01


def test_labelled_junk_of_the_given_table_is_rejected(spark):
    """By the learned vector: none of it fails the base rule; good rows stay."""
    rows = quality.op2_quality_rules(spark, "/root/testdata/sf0.01").where("not base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    counts = {(r.quality, r.kept): r["count"] for r in rows.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert counts.get((0, False), 0) >= 20 and (0, True) not in counts and (1, False) not in counts


def test_null_strata_empty_tables_and_columns(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (1, None), (None, 1)], "doc_id long, quality int")
    kept = quality.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and [r.doc_id for r in kept.collect()] == []
    assert quality.keep_good(no_docs, labels.limit(0)).count() == 0
    long = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(80)), None)], "doc_id long, text string, lang string")
    assert quality.keep_good(long, labels.limit(0)).count() == 1


def test_no_python_in_the_plan(spark, odd_docs):
    plan = quality.measured(odd_docs, "m")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
