"""Stop-words, term frequencies per label, two-word collocations, cloud lists.

Counting is ``explode`` + ``groupBy().count()`` (map-side combine, so a very
frequent word is pre-aggregated per task). Stop-words are a fixed-size set
evaluated as an in-set predicate inside the projection - no join. Top terms
per label use ``row_number() <= k`` (partial top-k before the shuffle).
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.text import cased_tokens, term_tokens
from pulse.operators.limits import top_n
from pulse.schema import DOMAIN_STOPWORDS
from pulse.session import materialised

STOPWORD_LANGUAGES = ["english", "italian", "french", "spanish", "german", "portuguese"]
TOP_TERMS = 200
MIN_LLR = 30.0
LLR_EPS = 1e-10
BROADCAST_GROUPS = 10_000


@functools.lru_cache(maxsize=None)
def default_stopwords(languages: tuple[str, ...] = tuple(STOPWORD_LANGUAGES),
                      extra: tuple[str, ...] = tuple(DOMAIN_STOPWORDS)) -> tuple[str, ...]:
    """Spark ML's default stop-word lists for ``languages`` plus ``extra``.

    Read from the Spark ML jar's resources (the lists behind
    ``StopWordsRemover.loadDefaultStopWords``), so no JVM is needed and the
    SQL oracle can embed the identical list. Lower-cased, sorted, distinct.
    """
    import pyspark
    words: set[str] = set(w.lower() for w in extra)
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    if jars:
        with zipfile.ZipFile(jars[0]) as z:
            for lang in languages:
                data = z.read(f"org/apache/spark/ml/feature/stopwords/{lang}.txt").decode("utf-8")
                words.update(w.strip().lower() for w in data.split("\n") if w.strip())
    else:  # pragma: no cover - needs a running JVM
        from pyspark.ml.feature import StopWordsRemover
        for lang in languages:
            words.update(w.lower() for w in StopWordsRemover.loadDefaultStopWords(lang))
    return tuple(sorted(words))


def _not_stop(col, stopwords) -> Column:
    return ~col.isin(list(stopwords))


def remove_stopwords(terms: DataFrame, stopwords=None, col: str = "term") -> DataFrame:
    """A5: drop stop-words from a frame of terms."""
    sw = stopwords if stopwords is not None else default_stopwords()
    return terms.filter(_not_stop(F.col(col), sw))


def term_counts(df: DataFrame, group_cols: list[str], text_col: str = "text",
                stopwords=None) -> DataFrame:
    """Per-group term counts after stop-word removal: group..., term, n."""
    sw = stopwords if stopwords is not None else default_stopwords()
    terms = df.select(*group_cols, F.explode(term_tokens(F.col(text_col))).alias("term"))
    return (remove_stopwords(terms, sw).groupBy(*group_cols, "term")
            .agg(F.count(F.lit(1)).alias("n")))


def term_frequency(df: DataFrame, group_cols: list[str], text_col: str = "text",
                   top: int = TOP_TERMS, stopwords=None, counted: PairCounts | None = None) -> DataFrame:
    """The ``top`` most frequent terms per group (ties by term), ranked.

    ``counted``: the counts of the same texts, where they were made already.
    """
    counts = term_counts(df, group_cols, text_col, stopwords) if counted is None else counted.words
    ranked = top_n(counts, group_cols, [F.col("n").desc(), F.col("term").asc()], top, "rank")
    # cloud weight: count relative to the group's most frequent term
    # (a window over at most ``top`` rows per group)
    top_count = F.max("n").over(Window.partitionBy(*group_cols))
    return ranked.withColumn("weight", F.round(F.col("n") / top_count, 6))


class PairCounts(NamedTuple):
    """What ``pair_counts`` found: ``group..., w1, w2, _n`` and ``group..., term, n``."""
    pairs: DataFrame
    words: DataFrame


def pair_counts(df: DataFrame, group_cols: list[str], text_col: str = "text", stopwords=None) -> PairCounts:
    """Counts of all words and adjacent pairs per group, stop-words removed, as tables
    in the shared scratch folder: the texts are read and tokenised once for A6 and A7.

    Zipping the tokens with themselves shifted by one gives every token once as
    w1 (the last one, or one before a stop-word, with w2 = null) and every
    adjacent pair; one partial aggregate counts both. Word counts are then sums
    over that (much smaller) table.
    """
    sw = stopwords if stopwords is not None else default_stopwords()
    toks = df.select(*group_cols, term_tokens(F.col(text_col)).alias("_t"))
    nxt = F.slice("_t", 2, F.size("_t"))
    grams = toks.select(*group_cols, F.explode(F.arrays_zip(F.col("_t").alias("w1"), nxt.alias("w2"))).alias("_z"))
    grams = grams.select(*group_cols, F.col("_z.w1").alias("w1"), F.col("_z.w2").alias("w2"))
    kept = (grams.filter(_not_stop(F.col("w1"), sw))
            .withColumn("w2", F.when(F.col("w2").isNotNull() & _not_stop(F.col("w2"), sw), F.col("w2"))))
    pairs = materialised(kept.groupBy(*group_cols, "w1", "w2").agg(F.count(F.lit(1)).alias("_n")), "pair_counts")
    words = pairs.groupBy(*group_cols, F.col("w1").alias("term")).agg(F.sum("_n").alias("n"))
    return PairCounts(pairs, materialised(words, "word_counts"))


def likelihood_ratio(c12: str, c1: str, c2: str, n: str) -> Column:
    """Dunning's log-likelihood ratio of a pair from the columns of its count, of
    its words' counts and of all words (formula in ``collocations``)."""
    N, a, b, ab = (F.col(c).cast("double") for c in (n, c1, c2, c12))

    def L(k, n, x):
        return k * F.log(F.greatest(x, F.lit(LLR_EPS))) + (n - k) * F.log(F.greatest(1 - x, F.lit(LLR_EPS)))

    p, p1, p2 = b / N, ab / a, (b - ab) / (N - a)
    llr = -2 * (L(ab, a, p) + L(b - ab, N - a, p) - L(ab, a, p1) - L(b - ab, N - a, p2))
    return F.when((N <= a) | (N <= b), F.lit(0.0)).otherwise(llr)


def collocations(df: DataFrame, group_cols: list[str], text_col: str = "text",
                 min_llr: float = MIN_LLR, stopwords=None, counted: PairCounts | None = None) -> DataFrame:
    """Adjacent word pairs scored with Dunning's log-likelihood ratio.

    Pairs are formed within one text before stop-word removal, and kept only
    when neither word is a stop-word. With N the group's unigram count (after
    stop-word removal), c1 / c2 the words' counts and c12 the pair count:
    p = c2/N, p1 = c12/c1, p2 = (c2-c12)/(N-c1),
    L(k, n, x) = k ln max(x, eps) + (n-k) ln max(1-x, eps),
    LLR = -2 [L(c12,c1,p) + L(c2-c12,N-c1,p) - L(c12,c1,p1) - L(c2-c12,N-c1,p2)],
    and 0 when N <= c1 or N <= c2. Pairs with LLR > ``min_llr`` are returned.
    ``counted``: the counts of the same texts, where they were made already.
    """
    counts, uni = pair_counts(df, group_cols, text_col, stopwords) if counted is None else counted
    c12 = counts.filter(F.col("w2").isNotNull()).withColumnRenamed("_n", "c12")
    totals = uni.groupBy(*group_cols).agg(F.sum("n").alias("n_words"))
    # groups are few (platforms x labels): their totals are broadcast, so the pairs
    # are not shuffled on a handful of keys; many groups are joined by shuffle
    if totals.count() <= BROADCAST_GROUPS:
        totals = F.broadcast(totals)
    u1 = uni.select(*group_cols, F.col("term").alias("w1"), F.col("n").alias("c1"))
    u2 = uni.select(*group_cols, F.col("term").alias("w2"), F.col("n").alias("c2"))
    # words before groups: a sort compares the first key's bytes, and groups are few
    scored = c12.join(u1, ["w1", *group_cols]).join(u2, ["w2", *group_cols]).join(totals, group_cols)
    return (scored.withColumn("llr", likelihood_ratio("c12", "c1", "c2", "n_words")).filter(F.col("llr") > min_llr)
            .select(*group_cols, "w1", "w2", "c12", "c1", "c2", "n_words", "llr"))


def cloud_list(df: DataFrame, group_cols: list[str], text_col: str = "text", top: int = TOP_TERMS,
               min_llr: float = MIN_LLR, stopwords=None) -> DataFrame:
    """A6 and A7 as one ranked list per group: ``rank, entry, is_phrase, n, weight``.

    Words that differ in case only are one word, and a plural in ``-s`` (not
    ``-ss``) counts as its singular where the group has that. A word is shown in
    its most frequent spelling (of equal counts the least), a merged one in that of
    the singular. A pair of neighbours without a stop-word whose likelihood ratio,
    from the merged counts, exceeds ``min_llr`` is a phrase; its count is taken
    off both of its words, and words without a count left are not shown. The
    ``top`` entries by count, then by entry, are ranked; ``weight`` is the count
    relative to the first. A group without words has no rows; a null text has none.
    Group columns are not null.
    """
    sw = stopwords if stopwords is not None else default_stopwords()
    g = list(group_cols)
    words = df.select(*g, cased_tokens(F.col(text_col)).alias("_t"))
    pairs = F.arrays_zip(F.col("_t").alias("w1"), F.slice("_t", 2, F.size("_t")).alias("w2"))
    grams = words.select(*g, F.explode(pairs).alias("_z")).select(*g, "_z.w1", "_z.w2")
    free = grams.filter(_not_stop(F.lower("w1"), sw)).withColumn(
        "w2", F.when(F.col("w2").isNotNull() & _not_stop(F.lower("w2"), sw), F.lower("w2")))
    counts = materialised(free.groupBy(*g, "w1", "w2").agg(F.count(F.lit(1)).alias("c")), "cloud_pairs")

    # spellings: counted, then the most frequent of each lower-case word
    spelt = counts.groupBy(*g, "w1").agg(F.sum("c").alias("c"))
    keys = spelt.groupBy(*g, F.lower("w1").alias("key")).agg(
        F.min_by("w1", F.struct(-F.col("c"), F.col("w1"))).alias("spelling"), F.sum("c").alias("c"))
    keys = materialised(keys, "cloud_words")
    single = keys.select(*g, F.col("key").alias("single"), F.col("spelling").alias("single_spelling"))
    stem = F.when(F.col("key").endswith("s") & ~F.col("key").endswith("ss"), F.expr("left(key, length(key) - 1)"))
    merged = keys.withColumn("single", stem).join(single, ["single", *g], "left").select(
        *g, "key", F.when(F.col("single_spelling").isNotNull(), F.col("single")).otherwise(F.col("key")).alias("word"),
        F.coalesce("single_spelling", "spelling").alias("spelling"), "c")
    merged = materialised(merged, "cloud_merged")
    totals = materialised(merged.groupBy(*g, "word", "spelling").agg(F.sum("c").alias("n")), "cloud_totals")
    all_words = totals.groupBy(*g).agg(F.sum("n").alias("n_words"))
    if all_words.count() <= BROADCAST_GROUPS:
        all_words = F.broadcast(all_words)

    # phrases, over the merged words: each word of a pair brings its merged word and
    # that one's count in one join, so the pairs are shuffled once a word and once to
    # be summed; words come before groups in the keys (see ``collocations``)
    counted = materialised(merged.select(*g, "key", "word").join(totals.select(*g, "word", "n"), ["word", *g]), "cloud_counted")
    of = lambda k, w, c: counted.select(*g, F.col("key").alias(k), F.col("word").alias(w), F.col("n").alias(c))
    both = (counts.filter(F.col("w2").isNotNull()).select(*g, F.lower("w1").alias("k1"), F.col("w2").alias("k2"), "c")
            .join(of("k1", "a", "c1"), ["k1", *g]).join(of("k2", "b", "c2"), ["k2", *g])
            .groupBy("a", "b", *g).agg(F.sum("c").alias("c12"), F.max("c1").alias("c1"), F.max("c2").alias("c2")))
    found = both.join(all_words, g).filter(likelihood_ratio("c12", "c1", "c2", "n_words") > min_llr).select(*g, "a", "b", "c12")
    spelt_as = lambda w: totals.select(*g, F.col("word").alias(w), F.col("spelling").alias(f"s_{w}"))
    phrases = materialised(found.join(spelt_as("a"), ["a", *g]).join(spelt_as("b"), ["b", *g])
                           .select(*g, "a", "b", "c12", F.concat_ws(" ", "s_a", "s_b").alias("entry")), "cloud_phrases")

    used = (phrases.select(*g, F.explode(F.array("a", "b")).alias("word"), "c12").groupBy(*g, "word").agg(F.sum("c12").alias("used")))
    left = totals.join(used, [*g, "word"], "left").select(
        *g, F.col("spelling").alias("entry"), F.lit(False).alias("is_phrase"), (F.col("n") - F.coalesce("used", F.lit(0))).alias("n"))
    entries = left.filter("n > 0").unionByName(phrases.select(*g, "entry", F.lit(True).alias("is_phrase"), F.col("c12").alias("n")))
    ranked = top_n(entries, g, [F.col("n").desc(), F.col("entry"), F.col("is_phrase")], top, "rank")
    return ranked.withColumn("weight", F.round(F.col("n") / F.max("n").over(Window.partitionBy(*g)), 6))
