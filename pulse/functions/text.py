"""Text expressions: cleaning, blank test, emoji and token extraction.

All functions return native Column expressions (regexp_replace / rlike /
regexp_extract_all), so they stay inside whole-stage codegen and never cross
into Python. The patterns are written once here and shared with the SQL
oracle, which runs the same regular expressions in DuckDB.

Java's ``\\s`` and ``trim`` only know ASCII whitespace, while the original
application stripped and collapsed with Unicode-aware rules; ``WS`` spells the
Unicode whitespace set out explicitly so both engines agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulse.schema import MAX_SCORED_TOKENS

# Unicode whitespace (the set Python's str.strip / re \s use) and its negation.
_WS_BODY = (r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS = "[" + _WS_BODY + "]"
NWS = "[^" + _WS_BODY + "]"

# Thread cleaning: strip, drop http(s) links, newline runs -> one space.
THREAD_STRIP = r"\A" + WS + "+|" + WS + r"+\z"
THREAD_URL = "https?://" + NWS + "+"
NEWLINES = r"\n+"

# Comment cleaning: links (also bare www.) -> one space, whitespace runs ->
# one space, then the single leading / trailing space left is removed.
COMMENT_URL = "https?://" + NWS + "+|www\\." + NWS + "+"
WS_RUN = WS + "+"
EDGE_SPACE = r"\A | \z"
# The runs that are not one plain space already, in any text and in ASCII alone.
UNEVEN_RUN = " " + WS + "+|[" + _WS_BODY.replace(r"\s", r"\t-\r") + "]" + WS + "*"
UNEVEN_RUN_ASCII = r" [\t-\r\x1c-\x20]+|[\t-\r\x1c-\x1f][\t-\r\x1c-\x20]*"


def _emoji_class() -> str:
    """Character class of the code points with Unicode's Emoji property, built
    from the installed Unicode data (neither Java 17 nor RE2 know the property).

    Digits, ``#`` and ``*`` are emoji only as keycaps and regional indicators
    only in pairs, so both are left out.
    """
    import regex
    member = regex.compile(r"[\p{Emoji}--[0-9#*\U0001F1E6-\U0001F1FF]]", regex.V1)
    ranges: list[list[int]] = []
    for c in range(0xA0, 0x1FB00):
        if member.match(chr(c)):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(rf"\x{{{a:X}}}" + (rf"-\x{{{b:X}}}" if b > a else "") for a, b in ranges)


# Emoji: flags (pairs of regional indicators, or a black flag with tags),
# keycaps, and characters of the Emoji property with an optional variation
# selector or skin tone, joined by ZWJ into sequences. A character that shows
# as text without U+FE0F counts with and without it.
_PICTO = "[" + _emoji_class() + r"](?:\x{FE0F}|[\x{1F3FB}-\x{1F3FF}])?"
EMOJI = (r"[\x{1F1E6}-\x{1F1FF}]{2}|[0-9#*]\x{FE0F}?\x{20E3}|"
         r"\x{1F3F4}[\x{E0020}-\x{E007E}]+\x{E007F}|"
         + _PICTO + r"(?:\x{200D}" + _PICTO + ")*")

# No emoji without one of these: the two below U+2000, or anything from there on.
_MAY_SHOW = r"\x{A9}\x{AE}\x{2000}-\x{10FFFF}"
EMOJI_SIGN = f"[{_MAY_SHOW}]"
# Runs that are part of no emoji (digits, # and * are, as keycaps).
EMOJI_FREE = f"[^0-9#*{_MAY_SHOW}]+"

# Word tokens: a letter/digit/underscore followed by at least one more
# letter/digit/underscore/apostrophe (Unicode classes; never \w or \b).
TOKEN = r"[\p{L}\p{N}_][\p{L}\p{N}_']+"
ALL_DIGITS = r"\A\p{Nd}+\z"
POSSESSIVE = r"'s\z"
POSSESSIVE_CASED = r"'[sS]\z"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def clean_thread_text(col) -> Column:
    """Null -> one space; else strip, remove links, newline runs -> space.

    The link removal leaves its neighbours' spaces in place, and ``www.``
    addresses are kept - both as in the thread collector.
    """
    c = _c(col)
    stripped = F.regexp_replace(c, THREAD_STRIP, "")
    no_links = F.regexp_replace(stripped, THREAD_URL, "")
    return F.when(c.isNull(), F.lit(" ")).otherwise(F.regexp_replace(no_links, NEWLINES, " "))


def clean_comment_text(col) -> Column:
    """Links and www. addresses -> space, collapse whitespace, strip.

    A missing text is treated as the empty string.
    """
    c = F.coalesce(_c(col), F.lit(""))
    # only texts with a link are searched for links, and a plain single space,
    # by far the most frequent run, is left as it is; spaces are then single, so
    # trimming takes off one at each edge
    no_links = F.when(c.contains("://") | c.contains("www."), F.regexp_replace(c, COMMENT_URL, " ")).otherwise(c)
    collapsed = F.when(_ascii(c), F.regexp_replace(no_links, UNEVEN_RUN_ASCII, " ")).otherwise(
        F.regexp_replace(no_links, UNEVEN_RUN, " "))
    return F.trim(collapsed)


def has_text(col) -> Column:
    """non-null and at least one non-whitespace character."""
    c = _c(col)
    return c.isNotNull() & c.rlike(NWS)


def distinct_emoji(col) -> Column:
    """Distinct emoji in first-appearance order (empty array for none).

    Most texts are told to hold none by their byte count or by one small class; of
    the others, each run that is part of no emoji is one space before the search.
    """
    c = F.coalesce(_c(col), F.lit(""))
    found = F.array_distinct(F.regexp_extract_all(F.regexp_replace(c, EMOJI_FREE, " "), F.lit(EMOJI), 0))
    return F.when((F.octet_length(c) != F.length(c)) & c.rlike(EMOJI_SIGN), found).otherwise(F.array().cast("array<string>"))


def emoji_csv(col) -> Column:
    """Emoji array -> comma-joined cell; null stays null."""
    return F.array_join(_c(col), ",")


def preview(col, n: int = 100) -> Column:
    """First ``n`` characters of a text."""
    return F.substring(_c(col), 1, n)


def tokens(col) -> Column:
    """Lower-cased word tokens of a text, in order."""
    c = F.lower(F.coalesce(_c(col), F.lit("")))
    return F.regexp_extract_all(c, F.lit(TOKEN), 0)


def cased_tokens(col) -> Column:
    """Tokens as ``term_tokens`` gives them, in the letters of the text."""
    found = F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit(TOKEN), 0)
    return _counted(found, lambda t: t.endswith("'s") | t.endswith("'S"))


def truncate_tokens(tok: Column, n: int = MAX_SCORED_TOKENS) -> Column:
    """Keep the first ``n`` tokens."""
    return F.slice(tok, 1, n)


def term_tokens(col) -> Column:
    """Tokens as counted for term clouds: lower-cased, trailing 's removed,
    all-digit tokens dropped (stop-words are removed later by a join)."""
    return _counted(tokens(col), lambda t: t.endswith("'s"))


def _counted(found: Column, possessive) -> Column:
    """``found`` without the ending of possessives and without all-digit tokens. A
    token is tested by its bytes; only one that does not begin with an ASCII letter
    can be all digits, so few are matched with the pattern."""
    stripped = F.transform(found, lambda t: F.when(possessive(t), F.left(t, F.length(t) - 2)).otherwise(t))
    letter = lambda t: ((t >= "a") & (t < "{")) | ((t >= "A") & (t < "["))
    return F.filter(stripped, lambda t: letter(t) | ~t.rlike(ALL_DIGITS))
