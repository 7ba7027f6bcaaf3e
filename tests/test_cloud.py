"""One ranked list of words and phrases per group."""

from pulse.operators.terms import cloud_list


def _rows(spark, texts, **kw):
    df = spark.createDataFrame([("g", t) for t in texts], "g string, text string")
    return [(r.entry, r.is_phrase, r.n, r["rank"]) for r in cloud_list(df, ["g"], stopwords=["of", "the"], **kw).orderBy("rank").collect()]


def test_spelling_plural_and_possessive(spark):
    got = _rows(spark, ["Boat", "boat", "Boat", "boats", "Boat's 123", "glass", "the of", None, ""], min_llr=1e9)
    assert got == [("Boat", False, 5, 1), ("glass", False, 1, 2)]
    # the singular's spelling stands for both, ties go to the least
    assert _rows(spark, ["CATS CATS", "cat", "Cat"], min_llr=1e9) == [("Cat", False, 4, 1)]
    # a plural without its singular stays
    assert _rows(spark, ["dogs", "dogs"]) == [("dogs", False, 2, 1)]


def test_phrases_take_their_words_along(spark):
    texts = ["new York"] * 30 + ["new"] * 2 + [f"word{i} filler{i}x" for i in range(60)]
    got = {e: (p, n) for e, p, n, _ in _rows(spark, texts)}
    assert got["new York"] == (True, 30) and got["new"] == (False, 2) and "York" not in got
    # no phrase over a stop-word
    over = {e: p for e, p, _, _ in _rows(spark, ["king of hearts"] * 30 + [f"w{i} v{i}" for i in range(60)])}
    assert not over["king"] and not over["hearts"] and "king hearts" not in over


def test_limit_and_ties(spark):
    got = _rows(spark, ["bb aa cc"], top=2, min_llr=1e9)
    assert got == [("aa", False, 1, 1), ("bb", False, 1, 2)]
    assert _rows(spark, [None, "", "the"]) == []
