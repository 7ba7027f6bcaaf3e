"""Label expressions: answer parsing, label <-> ordinal, display colour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulse.schema import LABEL_COLOURS, LABELS, NEUTRAL, NEUTRAL_ORDINAL


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _labels() -> Column:
    return F.array(*[F.lit(x) for x in LABELS])


def label_to_ordinal(col) -> Column:
    """T5: label -> 0..4; anything else -> 2 (Neutral)."""
    pos = F.array_position(_labels(), _c(col))
    return F.when(pos > 0, pos - 1).otherwise(F.lit(NEUTRAL_ORDINAL)).cast("int")


def ordinal_to_label(col) -> Column:
    """T5: 0..4 -> label; anything else -> Neutral."""
    return F.coalesce(F.try_element_at(_labels(), _c(col).cast("int") + 1), F.lit(NEUTRAL))


def label_colour(col) -> Column:
    """Display colour of a label (unknown labels get the Neutral colour)."""
    colours = F.array(*[F.lit(x) for x in LABEL_COLOURS])
    return F.element_at(colours, label_to_ordinal(col) + 1)


def extract_label(col, mode: str = "longest") -> Column:
    """T4: free-text model answer -> one of the five labels (case-sensitive).

    ``scale_order`` reproduces the original rule: the first label of the scale
    that occurs anywhere in the answer wins, so "Very Positive" can never be
    returned (it contains "Positive", tested first). ``longest`` (default)
    takes the leftmost label in the answer, preferring the two-word labels at
    the same position. No label -> Neutral.
    """
    c = F.coalesce(_c(col), F.lit(""))
    if mode == "scale_order":
        expr = None
        for label in LABELS:
            cond = c.contains(label)
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        return expr.otherwise(F.lit(NEUTRAL))
    if mode == "longest":
        two_words = [x for x in LABELS if " " in x]
        one_word = [x for x in LABELS if " " not in x]
        alternation = "(" + "|".join(two_words + one_word) + ")"
        hit = F.regexp_extract(c, alternation, 1)
        return F.when(hit == "", F.lit(NEUTRAL)).otherwise(hit)
    raise ValueError(f"unknown mode {mode!r}")


def ordinal_from_score(score: Column) -> Column:
    """Lexicon score -> ordinal: <=-2 -> 0, -1 -> 1, 0 -> 2, 1 -> 3, >=2 -> 4."""
    return (F.least(F.greatest(score, F.lit(-2)), F.lit(2)) + 2).cast("int")
