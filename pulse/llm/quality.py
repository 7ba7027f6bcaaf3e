"""Quality rules with risk-controlled thresholds (operator 2).

Rules compare a ratio of a document with a cutoff and reject what lies above.
The cutoffs are not set by hand. A fixed sequence of whole rule vectors, each
adding or tightening one cutoff (``steps_of``), is tested on the labelled
documents of a stratum (by default the language): an exact binomial test asks
whether the share of good documents that the *vector* rejects lies below
``alpha``, and the sequence stops at the first failure (fixed-sequence testing
needs no correction within it). The level ``delta`` is divided by the number of
sequences tested (Bonferroni). So with probability ``1 - delta`` all rules
together reject at most the share ``alpha`` of the good documents of every
tested stratum. Among the admitted vectors the one that rejects most of the bad
holdout documents is chosen, the most lenient of equals; where none rejects a
bad document the stratum has no learned rule.

A stratum with so few good labels that even a vector without any false
rejection could not pass (fewer than ln(delta / strata) / ln(1 - alpha)) takes
the vector of one more sequence, tested on all strata together; there the bound
holds for the good documents of the whole table.

Everything is a column expression: a document's counts are taken within its row,
so the text is never shuffled, and repeated three-word windows are found by one
sort of the row's windows. Calibration sums the grid per stratum in one
pre-aggregated pass.

Defined cases: a null text has no words and fails the base rule; a null stratum
is a stratum of its own; a stratum without any label rejects nothing beyond the base
rule; several labels of one doc_id count as good only if all are; labels that are
null or of no document are ignored; repeated rows are judged each by itself; an
empty table gives an empty result; columns of the input with any name are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import small_or_shuffled, written

#: fixed values: white space between words, counted symbols
WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MOST_REPEAT_PERCENT = 50
ALPHA = 0.01
DELTA = 0.05

#: rule: grid of cutoffs, most lenient first
GRID = {
    "symbol_ratio": [2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05],
    "repeat_ratio": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2],
    "dup_line_ratio": [0.8, 0.6, 0.5, 0.4, 0.3, 0.2],
    "bang_ratio": [1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1],
    "word_length": [9.0, 8.0, 7.5, 7.0, 6.5],
}

#: rules whose cutoffs come after those of all others in the sequence
LATE = ("word_length",)


def steps_of(grid: dict[str, list[float]], late: tuple[str, ...] = LATE) -> list[tuple[str, float]]:
    """The sequence of cutoffs that enter the vector one by one: the most
    lenient of every rule, then the second of every rule, and so on."""
    rank = lambda rule, i, k: (rule in late, i, k)
    found = sorted((rank(rule, i, k), rule, cut) for k, (rule, cuts) in enumerate(grid.items()) for i, cut in enumerate(cuts))
    return [(rule, cut) for _, rule, cut in found]


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    The row's windows are sorted, equal neighbours are repeats, and their
    positions cover up to three words each.
    """
    n = F.size(words) - 2
    windows = F.arrays_zip(F.slice(words, 1, n).alias("a"), F.slice(words, 2, n).alias("b"),
                           F.slice(words, 3, n).alias("c"), F.sequence(F.lit(0), n - 1).alias("p"))
    same = lambda x, y: (x["c"] == y["c"]) & (x["b"] == y["b"]) & (x["a"] == y["a"])
    repeats = lambda s: F.transform(F.filter(
        s, lambda x, i: F.coalesce(same(x, F.get(s, i + 1)), F.lit(False))
        | F.coalesce(same(x, F.get(s, i - 1)), F.lit(False))), lambda x: x["p"])
    # bound as a lambda's variable, the sorted array is made once per row
    at = F.transform(F.array(F.sort_array(windows)), lambda s: F.sort_array(repeats(s)))[0]
    covered = F.transform(F.array(at), lambda p: F.aggregate(
        F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))),
                   lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
        F.lit(0), lambda s, x: s + x))[0]
    return F.when(n >= 2, covered).otherwise(F.lit(0)).cast("long")


def _free_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def measured(docs: DataFrame, column: str, stratum: str = "lang", text: str = "text") -> DataFrame:
    """``docs`` with the struct ``column`` of counts, ratios and stratum."""
    t, w, s = (_free_name(docs, x) for x in ("_t", "_w", "_s"))
    word_split = F.split(F.col(t), "[ \t\n\x0b\f\r]+")
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = (docs.withColumn(t, F.btrim(whole, F.lit(WHITE)))
           .withColumn(w, F.when(F.col(t) == "", F.array().cast("array<string>")).otherwise(word_split))
           .withColumn(s, F.struct(
               F.size(w).cast("long").alias("n_words"),
               (F.length(whole) - F.octet_length(whole) + F.octet_length(_without(whole, WHITE))).cast("long").alias("word_chars"),
               (F.octet_length(whole) - F.octet_length(_without(whole, SYMBOLS))).cast("long").alias("n_symbols"),
               F.transform(F.array(lines), lambda x: F.struct(
                   F.size(x).cast("long").alias("all"), F.size(F.array_distinct(x)).cast("long").alias("distinct")))[0].alias("lines"),
               _repeat_words(F.col(w)).alias("n_repeat_words"),
               (F.octet_length(whole) - F.octet_length(_without(whole, "!"))).cast("long").alias("n_bangs")))
           .drop(w, t))
    c = lambda name: F.col(f"{s}.{name}")
    words = F.greatest(c("n_words"), F.lit(1)).cast("double")
    out = out.withColumn(column, F.struct(
        c("n_words"), c("word_chars"), c("n_symbols"), (c("lines.all") - c("lines.distinct")).alias("n_dup_lines"),
        c("n_repeat_words"),
        ((c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MOST_REPEAT_PERCENT * c("n_words"))).alias("base_failed"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("\0null")).alias("stratum"),
        (c("n_symbols") / words).alias("symbol_ratio"), (c("n_repeat_words") / words).alias("repeat_ratio"),
        ((c("lines.all") - c("lines.distinct")) / F.greatest(c("lines.all"), F.lit(1)).cast("double")).alias("dup_line_ratio"),
        (c("n_bangs") / words).alias("bang_ratio"), (c("word_chars") / words).alias("word_length")))
    return out.drop(s)


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series after a shift by eight."""
    x = x.cast("double")
    z = x + 8
    shift = x
    for k in range(1, 8):
        shift = shift * (x + k)
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(shift)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact to double precision; 1 where k >= n p.

    Summed from the term of k downwards, where the terms fall; the number of
    terms grows with the square root of n, what is left out is below 1e-20 of
    the sum.
    """
    k, n = k.cast("double"), n.cast("double")
    first = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
                  + k * math.log(p) + (n - k) * math.log1p(-p))
    terms = F.least(k, F.ceil(100 + 15 * F.sqrt(n))).cast("int")
    steps = F.when(terms > 0, F.sequence(F.lit(0), terms - 1)).otherwise(F.array().cast("array<int>"))
    odds = (1 - p) / p

    def add(acc, i):
        term = acc["term"] * (k - i) / (n - k + i + 1) * odds
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    ratio = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")), add, lambda acc: acc["sum"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), first * ratio))


def calibrate(rows: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
              grid: dict[str, list[float]] | None = None) -> DataFrame:
    """Chosen vector per stratum: ``stratum``, and a column per rule (null:
    off). ``rows`` has ``doc_id, stratum, base_failed`` and the ratios."""
    grid = grid or GRID
    steps = steps_of(grid)
    known = (labels.where("doc_id is not null and quality is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") == 1).alias("good")))
    # vectors are nested, so a row is rejected from its first step on
    first = F.least(*[F.when(F.col(rule) > cut, i).otherwise(len(steps)) for i, (rule, cut) in enumerate(steps)], F.lit(len(steps)))
    held = rows.where(~F.col("base_failed")).select("doc_id", "stratum", first.alias("first")).join(known, "doc_id")
    count = lambda c: F.sum(c.cast("long"))
    names = [f"{x}_{i}" for i in range(len(steps)) for x in "gb"]
    sums = [count(F.col("good")).alias("n")] + [
        count((F.col("first") <= i) & (F.col("good") if x == "g" else ~F.col("good"))).alias(f"{x}_{i}")
        for i in range(len(steps)) for x in "gb"]
    totals = written(held.groupBy("stratum").agg(*sums), "quality-holdout")
    need = math.ceil(math.log(delta / max(1, totals.count())) / math.log1p(-alpha))
    totals = totals.withColumn("own", F.col("n") >= need).withColumn(
        "sequence", F.when(F.col("own"), F.concat(F.lit("own "), "stratum")).otherwise("all"))
    pooled = (totals.agg(F.min("own").alias("own"), *[F.sum(c).alias(c) for c in ("n", *names)])
              .where(~F.col("own")).select(F.lit("all").alias("sequence"), "n", *names))
    sequences = totals.where("own").select("sequence", "n", *names).unionAll(pooled)
    level = delta / max(1, sequences.count())
    tests = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"g_{i}").alias("k"), F.col(f"b_{i}").alias("caught")) for i in range(len(steps))]))
    tested = sequences.select("sequence", "n", tests.alias("t")).select("sequence", "n", "t.*").withColumn(
        "passed", binomial_tail(F.col("k"), F.col("n"), alpha) <= level)
    upto = Window.partitionBy("sequence").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    chosen = (tested.withColumn("admitted", F.min("passed").over(upto)).where("admitted and caught > 0")
              .groupBy("sequence").agg(F.max_by("i", F.struct("caught", -F.col("i"))).alias("last")))
    cut = lambda rule: F.coalesce(*[F.when(F.col("last") >= i, F.lit(c))
                                    for i, (r, c) in reversed(list(enumerate(steps))) if r == rule])
    return totals.join(chosen, "sequence").select("stratum", *[cut(rule).alias(f"cut_{rule}") for rule in grid])


def judge(rows: DataFrame, thresholds: DataFrame, column: str, grid: dict[str, list[float]] | None = None) -> DataFrame:
    """``rows`` with the boolean ``kept_name`` from the struct ``column``."""
    grid = grid or GRID
    cuts = small_or_shuffled(written(thresholds, "quality-thresholds"))
    hit, kept = _free_name(rows, "_cuts"), _free_name(rows, "kept")
    cuts = cuts.select(F.struct(*cuts.columns).alias(hit))
    joined = rows.join(cuts, F.col(f"{column}.stratum") == F.col(f"{hit}.stratum"), "left")
    over = F.lit(False)
    for rule in grid:
        over = over | F.coalesce(F.col(f"{column}.{rule}") > F.col(f"{hit}.cut_{rule}"), F.lit(False))
    return joined.withColumn(kept, ~F.col(f"{column}.base_failed") & ~over).drop(hit)


def assess(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
           stratum: str = "lang", keep: list[str] | None = None) -> tuple[DataFrame, str, str]:
    """Judged documents, and the names of the measurements and verdict columns.

    ``keep`` lists the columns of ``docs`` to carry (all by default). The
    measurements are taken once and written to the shared scratch folder;
    calibration and verdict read that table.
    """
    column = _free_name(docs, "quality_measures")
    keep = docs.columns if keep is None else keep
    rows = written(measured(docs, column, stratum).select(*keep, column), "quality-measures")
    narrow = rows.select(F.col("doc_id").cast("long").alias("doc_id"), f"{column}.*")
    judged = judge(rows, calibrate(narrow, labels, alpha, delta), column)
    return judged, column, _free_name(rows, "kept")


def keep_good(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
              stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    judged, _, kept = assess(docs, labels, alpha, delta, stratum)
    return judged.where(F.col(kept)).select(*docs.columns)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged, column, kept = assess(docs, labels, keep=["doc_id"])
    return judged.select("doc_id", *[f"{column}.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")], F.col(kept).alias("kept"))


_SQL_STEPS = ", ".join(f"({i}, '{rule}', {cut!r}::DOUBLE)" for i, (rule, cut) in enumerate(steps_of(GRID)))

SQL_OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, chr(0) || 'null') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
tri AS (SELECT r, unnest(list_transform(range(1, len(ws) - 1), lambda i: {{'p': i, 'k': ws[i:i + 2]}})) AS x FROM w),
rep AS (SELECT r, x.p AS p FROM (SELECT r, x, count(*) OVER (PARTITION BY r, x.k) AS n FROM tri) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT p + o) AS n_repeat_words FROM rep, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
m AS (SELECT w.r, doc_id, stratum, len(ws)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '!')) AS n_bangs
      FROM w LEFT JOIN cov ON w.r = cov.r),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEAT_PERCENT} * n_words AS base_failed,
             MAP {{'symbol_ratio': n_symbols / greatest(n_words, 1), 'repeat_ratio': n_repeat_words / greatest(n_words, 1),
                   'dup_line_ratio': n_dup_lines / greatest(n_lines, 1), 'bang_ratio': n_bangs / greatest(n_words, 1),
                   'word_length': word_chars / greatest(n_words, 1)}} AS ratios FROM m),
steps AS (SELECT * FROM (VALUES {_SQL_STEPS}) AS g(i, rule, cutoff)),
vectors AS (SELECT a.i, b.rule, min(b.cutoff) AS cutoff FROM steps AS a JOIN steps AS b ON b.i <= a.i GROUP BY ALL),
known AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT f.*, good FROM f JOIN known ON f.doc_id = known.doc_id WHERE NOT base_failed),
sizes AS (SELECT stratum, count(*) FILTER (good) AS n FROM held GROUP BY stratum),
hits AS (SELECT stratum, i, count(DISTINCT r) FILTER (good) AS k, count(DISTINCT r) FILTER (NOT good) AS caught
         FROM held JOIN vectors ON ratios[rule] > cutoff GROUP BY stratum, i),
homes AS (SELECT stratum, n, CASE WHEN (1 - {ALPHA!r}) ** n <= {DELTA!r} / (SELECT count(*) FROM sizes) THEN stratum END AS own FROM sizes),
members AS (SELECT own AS seq, stratum, n FROM homes WHERE own IS NOT NULL
            UNION ALL SELECT NULL, stratum, n FROM homes WHERE EXISTS (SELECT 1 FROM homes WHERE own IS NULL)),
levels AS (SELECT {DELTA!r} / count(DISTINCT coalesce(seq, chr(0) || 'all')) AS level FROM members),
tested AS (SELECT seq, s.i, sum(n) AS n, coalesce(sum(k), 0) AS k, coalesce(sum(caught), 0) AS caught
           FROM members CROSS JOIN (SELECT DISTINCT i FROM steps) AS s
           LEFT JOIN hits ON hits.stratum = members.stratum AND hits.i = s.i GROUP BY seq, s.i),
tails AS (SELECT tested.*, level, CASE WHEN k >= n * {ALPHA!r} THEN 1.0 ELSE
              list_sum(list_transform(range(0, k::BIGINT + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                       + j * ln({ALPHA!r}) + (n - j) * ln(1 - {ALPHA!r})))) END AS tail FROM tested, levels),
admitted AS (SELECT *, min(tail <= level) OVER (PARTITION BY seq ORDER BY i) AS ok FROM tails),
chosen AS (SELECT seq, arg_max(i, {{'c': caught, 'v': -i}}) AS i FROM admitted WHERE ok AND caught > 0 GROUP BY seq),
bad AS (SELECT DISTINCT f.r FROM f JOIN homes ON f.stratum = homes.stratum JOIN chosen ON homes.own IS NOT DISTINCT FROM chosen.seq
        JOIN vectors ON vectors.i = chosen.i WHERE f.ratios[vectors.rule] > vectors.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r NOT IN (SELECT r FROM bad) AS kept
FROM f
"""
