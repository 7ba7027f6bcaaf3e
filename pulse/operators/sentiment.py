"""Labelling comments and threads with five-level sentiment.

Scorers:

* ``LexiconScorer`` - integer word weights summed over the whole text's
  tokens and bucketed (<=-2 Very Negative ... >=2 Very Positive). A dict is
  evaluated inside the projection, one hash-set membership test per distinct
  weight (``CASE WHEN token IN (...) THEN w``): row-local, no shuffle, O(1) per
  token. A lexicon table is joined to the tokens; both give the same scores.
* ``TrainedScorer`` - ``pyspark.ml`` tokenizer -> hashing TF -> multinomial
  logistic regression; probability vector and argmax label.
* ``PandasScorer`` - extension point for a caller-supplied model, applied
  with an Arrow-batched pandas UDF (model loaded once per task).

Every labelled frame gets ``sentiment``, ``ordinal`` and ``defaulted`` (True
when the label was not produced by the scorer - blank text, no answer - and
Neutral was assigned instead).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.labels import ordinal_from_score, ordinal_to_label
from pulse.functions.text import has_text, tokens
from pulse.operators.threads import thread_text, thread_texts
from pulse.schema import NEUTRAL_ORDINAL, THREAD_SEPARATOR


class LexiconScorer:
    """Sum of integer word weights over the text's tokens, row by row.

    A dict is written into the projection (one hash-set membership test per
    distinct weight). A DataFrame (``word``, ``weight``; the weights of a word
    listed twice add up) is joined to the tokens of the distinct texts, which are
    known by their hash, so rows with equal or null ids are scored each by itself:
    both forms give the same scores. Nothing is collected.
    """

    def __init__(self, lexicon, max_tokens: int | None = None):
        self.lexicon = lexicon
        self.max_tokens = max_tokens

    @property
    def inline(self) -> bool:
        return isinstance(self.lexicon, dict)

    def _tokens(self, text: Column) -> Column:
        tok = tokens(text)
        if self.max_tokens is not None:
            tok = F.slice(tok, 1, self.max_tokens)
        return tok

    def _weight_sum_sql(self) -> Column:
        """Sum of the weights of the tokens in column ``_pulse_tokens``."""
        by_weight: dict[int, list[str]] = {}
        for word, weight in self.lexicon.items():
            if int(weight) != 0:
                by_weight.setdefault(int(weight), []).append(word)
        if not by_weight:
            return F.lit(0).cast("bigint")
        # A map lookup would scan the keys; IN over a literal list becomes a
        # hash set. The expression is written as one SQL text so that a large
        # lexicon costs one parser call, not one call per word.
        def quote(w: str) -> str:
            return "'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'"
        branches = " ".join(
            f"WHEN t IN ({', '.join(quote(x) for x in sorted(words))}) THEN {w}"
            for w, words in sorted(by_weight.items()))
        listed = ", ".join(quote(w) for w in sorted(w for words in by_weight.values() for w in words))
        # few tokens have a weight: one test tells the others, which need no branch
        return F.expr(f"aggregate(filter(_pulse_tokens, t -> t IN ({listed})), CAST(0 AS BIGINT), "
                      f"(a, t) -> a + CAST(CASE {branches} ELSE 0 END AS BIGINT))")

    def weight_of(self, df: DataFrame, word: str) -> Column:
        """The weight of one word: a literal, or a scalar subquery."""
        if self.inline:
            return F.lit(int(self.lexicon.get(word, 0))).cast("bigint")
        return (self.lexicon.filter(F.col("word") == word)
                .select(F.coalesce(F.sum("weight"), F.lit(0)).cast("bigint")).scalar())

    def score(self, df: DataFrame, text_col: str) -> DataFrame:
        """Adds ``score`` (bigint) to ``df``, one row out per row in."""
        text = F.col(text_col)
        if self.inline:
            return (df.withColumn("_pulse_tokens", self._tokens(text))
                    .withColumn("score", self._weight_sum_sql()).drop("_pulse_tokens"))
        lex = self.lexicon.groupBy(F.col("word").alias("_tok")).agg(F.sum("weight").cast("bigint").alias("_weight"))
        # a score depends on the text alone, so texts are told apart by their hash
        key = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
        texts = df.select(key.alias("_key"), self._tokens(text).alias("_toks")).dropDuplicates(["_key"])
        sums = (texts.select("_key", F.explode("_toks").alias("_tok")).join(lex, "_tok")
                .groupBy("_key").agg(F.sum("_weight").alias("_sum")))
        return (df.withColumn("_key", key).join(sums, "_key", "left")
                .withColumn("score", F.coalesce("_sum", F.lit(0).cast("bigint"))).drop("_key", "_sum"))

    def label_scored(self, scored: DataFrame, blank: Column) -> DataFrame:
        """``ordinal, sentiment, defaulted`` from ``score``."""
        ordinal = F.when(blank, F.lit(NEUTRAL_ORDINAL)).otherwise(ordinal_from_score(F.col("score")))
        return (scored.withColumn("ordinal", ordinal.cast("int"))
                .withColumn("sentiment", ordinal_to_label(F.col("ordinal")))
                .withColumn("defaulted", blank))

    def label(self, df: DataFrame, text_col: str) -> DataFrame:
        return self.label_scored(self.score(df, text_col), ~has_text(F.col(text_col)))


def score_thread_rows(posts: DataFrame, comments: DataFrame, scorer: LexiconScorer) -> DataFrame:
    """T1 T3 over flat rows: the labels of ``score_threads`` without nesting.

    Lexicon scores add up over the glued text: the post, every non-blank comment,
    and the separator's word before each comment. So a thread is one sum by post
    (pre-aggregated per task), however many comments it has. A scorer with a token
    limit looks at the glued text itself and needs ``score_threads``.
    """
    if scorer.max_tokens is not None:
        raise ValueError("a token limit needs the glued text: use score_threads()")
    texts = scorer.score(thread_texts(posts, comments), "text")
    glue = THREAD_SEPARATOR.strip(" :")
    sums = texts.groupBy("item_id").agg(F.sum("score").alias("_sum"), F.count_if(~F.col("is_post")).alias("_n"))
    joined = posts.join(sums, posts["content_id"] == sums["item_id"], "left").drop("item_id")
    scored = joined.withColumn("score", F.coalesce(F.col("_sum") + F.col("_n") * scorer.weight_of(posts, glue), F.lit(0).cast("bigint")))
    return scorer.label_scored(scored, F.col("_sum").isNull()).drop("_sum", "_n")


class TrainedScorer:
    """Multinomial logistic regression over IDF-weighted hashed word presence.

    Classes are balanced with instance weights (total / (classes x class
    count)), so a rare label - e.g. abusive comments - is not drowned by the
    frequent ones. Tokenising, hashing, IDF and the optimiser's gradient
    passes are all distributed ``pyspark.ml`` stages.
    """

    def __init__(self, num_features: int = 1 << 18, max_iter: int = 50, reg: float = 0.1,
                 balance: bool = True):
        self.num_features = num_features
        self.max_iter = max_iter
        self.reg = reg
        self.balance = balance
        self.model = None

    def _pipeline(self, text_col: str):
        from pyspark.ml import Pipeline
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
        from pulse.functions.text import TOKEN
        return Pipeline(stages=[
            RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=TOKEN, gaps=False,
                           toLowercase=True, minTokenLength=1),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=self.num_features,
                      binary=True),
            IDF(inputCol="_counts", outputCol="_tf"),
            LogisticRegression(featuresCol="_tf", labelCol="_label", family="multinomial",
                               maxIter=self.max_iter, regParam=self.reg, weightCol="_w",
                               predictionCol="_pred", probabilityCol="probability",
                               rawPredictionCol="_raw"),
        ])

    def fit(self, train: DataFrame, text_col: str, ordinal_col: str) -> "TrainedScorer":
        data = train.select(F.coalesce(F.col(text_col), F.lit("")).alias(text_col),
                            F.col(ordinal_col).cast("double").alias("_label"))
        weight = F.lit(1.0)
        if self.balance:
            # one row per class (at most five): a bounded collect
            counts = {r[0]: r[1] for r in data.groupBy("_label").count().collect()}
            total = float(sum(counts.values()))
            expr = None
            for label, n in counts.items():
                w = F.lit(total / (len(counts) * n))
                cond = F.col("_label") == F.lit(label)
                expr = F.when(cond, w) if expr is None else expr.when(cond, w)
            weight = expr.otherwise(F.lit(1.0))
        self.model = self._pipeline(text_col).fit(data.withColumn("_w", weight))
        return self

    def label(self, df: DataFrame, text_col: str) -> DataFrame:
        if self.model is None:
            raise ValueError("fit() first")
        filled = df.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
        out = self.model.transform(filled)
        blank = ~has_text(F.col(text_col))
        ordinal = F.when(blank, F.lit(NEUTRAL_ORDINAL)).otherwise(F.col("_pred").cast("int"))
        return (out.withColumn("ordinal", ordinal.cast("int"))
                .withColumn("sentiment", ordinal_to_label(F.col("ordinal")))
                .withColumn("defaulted", blank)
                .drop("_words", "_counts", "_tf", "_raw", "_pred"))


class PandasScorer:
    """Caller-supplied model: ``fn(pd.Series[str]) -> pd.Series[int ordinal]``.

    Runs as an Arrow-batched pandas UDF. With ``load``, ``fn`` is called as
    ``fn(model, texts)`` and ``load()`` runs once per task, before its first
    batch. A text whose scoring fails, or whose answer is out of range, becomes
    Neutral with ``defaulted`` = True; a failing batch is halved until the failing
    texts are alone, so they take no others with them.
    """

    def __init__(self, fn: Callable, load: Callable | None = None):
        self.fn = fn
        self.load = load

    def label(self, df: DataFrame, text_col: str) -> DataFrame:
        fn, load = self.fn, self.load

        @F.pandas_udf("int")
        def _score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load() if load else None

            def answer(texts: pd.Series) -> list:
                try:
                    return list(fn(model, texts) if load else fn(texts))
                except Exception:  # noqa: BLE001 - any model failure: find the texts
                    if len(texts) == 1:
                        return [None]
                    half = len(texts) // 2
                    return answer(texts.iloc[:half]) + answer(texts.iloc[half:])

            for texts in batches:
                out = pd.Series(answer(texts.fillna("")) if len(texts) else [], index=texts.index, dtype="object")
                yield pd.to_numeric(out, errors="coerce").where(lambda s: s.between(0, 4)).astype("Int32")

        raw = _score(F.col(text_col))
        blank = ~has_text(F.col(text_col))
        scored = df.withColumn("_ord", F.when(blank, F.lit(None)).otherwise(raw))
        return (scored.withColumn("ordinal", F.coalesce("_ord", F.lit(NEUTRAL_ORDINAL)).cast("int"))
                .withColumn("sentiment", ordinal_to_label(F.col("ordinal")))
                .withColumn("defaulted", F.col("_ord").isNull())
                .drop("_ord"))


def score_comments(comments: DataFrame, scorer, text_col: str = "comment_raw_text") -> DataFrame:
    """One label per comment."""
    return scorer.label(comments, text_col)


def score_threads(threads: DataFrame, scorer) -> DataFrame:
    """One label per assembled thread document (T1 over its comments).

    Works on nested documents, as a stream of staged threads brings them; a blank
    thread is Neutral and flagged ``defaulted``. ``score_thread_rows`` gives the
    same labels from flat rows.
    """
    with_text = threads.withColumn("thread_text", thread_text())
    return scorer.label(with_text, "thread_text")
