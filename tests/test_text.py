"""Text expressions (hand cases + properties)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulse.functions import text as X

UNICODE_SPACES = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", " ", "\x85", "\xa0",
                  "\u1680", "\u2000", "\u2001", "\u2002", "\u2003", "\u2004", "\u2005", "\u2006", "\u2007",
                  "\u2008", "\u2009", "\u200a", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000"]


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("x")).first()["x"]


def test_thread_clean_hand_cases(spark):
    s = "  a https://x.y/z?q=1 b\n\nc www.k.it  "
    assert one(spark, X.clean_thread_text, s) == "a  b c www.k.it"
    assert one(spark, X.clean_thread_text, None) == " "
    assert one(spark, X.clean_thread_text, "https://x.y a") == " a"


def test_comment_clean_hand_cases(spark):
    s = "  a https://x.y/z?q=1 b\n\nc www.k.it  "
    assert one(spark, X.clean_comment_text, s) == "a b c"
    assert one(spark, X.clean_comment_text, None) == ""


def test_unicode_spaces_stripped(spark):
    for sp in UNICODE_SPACES:
        assert one(spark, X.clean_thread_text, f"{sp}word{sp}") == "word", repr(sp)
        assert one(spark, X.clean_comment_text, f"{sp}word{sp}") == "word", repr(sp)


def test_has_text(spark):
    df = spark.createDataFrame([(s,) for s in UNICODE_SPACES + [" x ", "", None]], "t string")
    got = [r[0] for r in df.select(X.has_text(F.col("t"))).collect()]
    assert got == [False] * len(UNICODE_SPACES) + [True, False, False]


ALPHABET = st.sampled_from(UNICODE_SPACES + list("ab.:/") + ["x", "\u00e9", "\U0001F600", "\u200b"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=25), min_size=40, max_size=40))
def test_cleaners_match_python_whitespace_rules(spark, texts):
    # No link in the alphabet: P7 reduces to Python's split/join, P6 to
    # strip + newline-run folding.
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", X.clean_comment_text("t").alias("c"), X.clean_thread_text("t").alias("p")).collect()
    for r in out:
        assert r["c"] == " ".join(r["t"].split())
        stripped = r["t"].strip()
        assert r["p"] == " ".join(part for part in stripped.split("\n") if part) or r["p"] == stripped == ""


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from(list("ab h:/w.") + ["https://", "www.", "\n", "\xa0"]),
                         max_size=12).map("".join), min_size=30, max_size=30))
def test_comment_clean_idempotent(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = df.select(X.clean_comment_text("t").alias("c"))
    twice = once.select("c", X.clean_comment_text("c").alias("cc")).collect()
    for r in twice:
        assert r["c"] == r["cc"]
        # a link needs at least one character after the scheme / www.
        assert not re.search(r"https?://\S|www\.\S", r["c"])


def test_distinct_emoji_first_appearance(spark):
    s = "a \U0001F600 b \U0001F44D\U0001F3FD c \u2764\ufe0f d \U0001F468\u200d\U0001F469\u200d\U0001F467 \U0001F1EE\U0001F1F9 \U0001F600"
    got = one(spark, X.distinct_emoji, s)
    assert got == ["\U0001F600", "\U0001F44D\U0001F3FD", "\u2764\ufe0f",
                   "\U0001F468\u200d\U0001F469\u200d\U0001F467", "\U0001F1EE\U0001F1F9"]
    assert one(spark, X.distinct_emoji, "plain text") == []
    assert one(spark, lambda c: X.emoji_csv(X.distinct_emoji(c)), "plain") == ""


def test_emoji_in_url_depends_on_input(spark):
    s = "see https://x.y/\U0001F600 now"
    assert one(spark, X.distinct_emoji, s) == ["\U0001F600"]
    assert one(spark, lambda c: X.distinct_emoji(X.clean_comment_text(c)), s) == []


def test_term_tokens(spark):
    got = one(spark, X.term_tokens, "The driver's 2025 Café won't x ab12")
    assert got == ["the", "driver", "café", "won't", "ab12"]


def test_empty_emoji_csv_cell_roundtrip(spark):
    from pulse.session import scratch_path
    from pulse.sinks.files import write_topic
    from pulse.sources.files import read_topic_csv
    path = scratch_path(spark, "csv_emoji")
    df = spark.createDataFrame([("a", ["\U0001F600", "\U0001F44D"]), ("b", [])], "content_id string, emoji array<string>")
    write_topic(df, path)
    back = dict(read_topic_csv(spark, path, "content_id string, emoji string").collect())
    assert back["a"] == "\U0001F600,\U0001F44D"
    assert back["b"] in ("", None) and back["b"] != "nan"
