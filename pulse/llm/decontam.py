"""Benchmark decontamination by a positional inverted index (operator 3).

Words are runs of letters and digits after lower-casing A-Z. A window is ten
consecutive words of a benchmark item (all of a shorter one); a document word
inside any occurrence of a window is hit.

1. The occurrences of every benchmark term are counted over all documents.
2. Every window is entered by its two rarest terms.
3. One pass over the documents stores the postings ``(term, text key, position)``
   of these terms, and the length of every document.
4. The list of the rarer term, moved by its offset in the item, is intersected
   with the list of the second one; what is left are diagonals (text, item,
   position of the item's beginning) on which whole windows may lie.
5. Each diagonal is compared word by word; runs of a whole window or more are the
   exact phrase matches.

Terms are 64-bit hashes up to step 4, which can only add diagonals that step 5
refuses. Texts are known by their MD5, so equal texts are compared once however
often they occur, and no group is ever larger than one text's own matches.
Tables that grow with the benchmark or with the matches are broadcast only below
the stated bound of their files; beyond it the joins shuffle. Only column
expressions are used.

Defined cases: a null text or item has no words; an item without words is left
out; a null item_id takes part in hits and is not listed; item rows that share an
id count as one item; equal documents give equal rows; empty tables give empty or
clean results; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import small_or_shuffled, written, written_small

WINDOW = 10
#: fixed value: what is no word character, before lower-casing
_NOT_WORD = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def raw_words(text: Column) -> Column:
    """Words in their own case: what lies between the runs of other characters."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), f"[{_NOT_WORD}]+"), "")


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased, other letters as they are."""
    return raw_words(F.translate(text.cast("string"), _UPPER, _UPPER.lower()))


def term_of(word: Column) -> Column:
    """Hash of a word after lower-casing A-Z; ``lower`` does that for ASCII."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.xxhash64(F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, _UPPER, _UPPER.lower())))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def item_table(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct word sequences of the items: ``item, words, size, span``
    (``span``: words of its windows)."""
    words = items.select(words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    return (words.select(F.unhex(F.md5(F.array_join("words", " ").cast("binary"))).alias("item"), "words")
            .dropDuplicates(["item"])
            .select("item", "words", F.size("words").alias("size"), F.least(F.lit(window), F.size("words")).alias("span")))


def item_ids(items: DataFrame) -> DataFrame:
    """``item, item_id`` (as text) of all items with words and an id."""
    return (items.select(words_of(F.col("text")).alias("words"), F.col("item_id").cast("string").alias("item_id"))
            .where("item_id is not null and size(words) > 0")
            .select(F.unhex(F.md5(F.array_join("words", " ").cast("binary"))).alias("item"), "item_id").distinct())


def occurrences(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n``: how often each of ``terms`` occurs in all documents."""
    found = docs.select(F.explode(raw_words(F.col("text"))).alias("word")).select(term_of(F.col("word")).alias("term"))
    return found.join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))


def anchors(items: DataFrame, counts: DataFrame) -> DataFrame:
    """Entries of the windows: ``item, p1, term1, p2, term2``, rarest first.

    ``p1`` and ``p2`` are word positions in the item; a window of one word has
    no second term.
    """
    placed = (items.select("item", "size", "span", F.posexplode("words").alias("p", "word"))
              .select("item", "size", "span", "p", term_of(F.col("word")).alias("term"))
              .join(counts, "term", "left"))
    rows = placed.groupBy("item", "size", "span").agg(F.array_sort(F.collect_list(
        F.struct("p", F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("at"))
    ranked = F.sort_array(F.transform(F.slice("at", F.col("w") + 1, F.col("span")), lambda x: F.struct(
        x["n"].alias("n"), x["p"].alias("p"), x["term"].alias("term"))))
    windows = rows.select("item", "span", "at", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("span"))).alias("w"))
    two = windows.select("item", ranked.alias("r"))
    return two.select("item", F.get("r", F.lit(0))["p"].alias("p1"), F.get("r", F.lit(0))["term"].alias("term1"),
                      F.get("r", F.lit(1))["p"].alias("p2"), F.get("r", F.lit(1))["term"].alias("term2")).distinct()


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: ``term, key, pos, doc_id``.

    Rows of ``terms`` are postings; a row with a null ``term`` stands for each
    document, its ``pos`` is the document's number of words.
    """
    # the empty word after the last one carries the length
    marked = terms.select("term", "term").toDF("hash", "term").unionByName(
        terms.sparkSession.range(1).select(F.xxhash64(F.lit("")).alias("hash"), F.lit(None).cast("long").alias("term")))
    marked = small_or_shuffled(written_small(marked, "decontam-terms"))
    # the key stands below the explode, so that it is computed once a document and not once a posting
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"),
                        F.concat(raw_words(F.col("text")), F.array(F.lit(""))).alias("words"))
    rows = keyed.select("doc_id", "key", F.posexplode("words").alias("pos", "word"))
    return rows.select("doc_id", "key", "pos", term_of(F.col("word")).alias("hash")).join(marked, "hash").select(
        "term", "key", "pos", F.when(F.col("term").isNull(), F.col("doc_id")).alias("doc_id"))


def diagonals(index: DataFrame, entries: DataFrame) -> DataFrame:
    """Offset-adjusted intersection: ``key, item, begin`` where both entry terms
    of a window stand as in the item."""
    lists = index.where("term is not null").select("term", "key", "pos").distinct()
    entries = small_or_shuffled(entries)
    first = lists.join(entries, F.col("term") == F.col("term1")).select(
        "key", "item", (F.col("pos") - F.col("p1")).alias("begin"), "p1", "p2", "term2")
    second = lists.select(F.col("key").alias("key2"), F.col("term").alias("t"), F.col("pos").alias("pos2"))
    both = first.where("p2 is not null").join(second, (F.col("key") == F.col("key2")) & (F.col("term2") == F.col("t"))
                                              & (F.col("begin") + F.col("p2") == F.col("pos2")), "left_semi")
    return first.where("p2 is null").select("key", "item", "begin").unionByName(both.select("key", "item", "begin")).distinct()


def _run_pattern(window: int) -> str:
    """Matches a 1 that lies in a run of ``window`` ones or more."""
    return "|".join(f"(?<=1{{{k}}})1(?=1{{{window - 1 - k}}})" for k in range(window))


def phrase_matches(docs: DataFrame, items: DataFrame, found: DataFrame, window: int = WINDOW) -> DataFrame:
    """Exact matches: ``key, item, hits`` (positions of the hit words)."""
    keyed = docs.select(text_key(F.col("text")).alias("key"), "text")
    wanted = small_or_shuffled(written_small(found.select("key").distinct(), "decontam-keys"))
    texts = keyed.join(wanted, "key", "left_semi").dropDuplicates(["key"]).select("key", words_of(F.col("text")).alias("doc"))
    rows = found.join(texts, "key").join(small_or_shuffled(items), "item")
    lo = F.greatest(F.lit(0), -F.col("begin"))
    n = F.greatest(F.lit(0), F.least(F.col("size"), F.size("doc") - F.col("begin")) - F.col("lo"))
    rows = rows.withColumn("lo", lo).withColumn("n", n).withColumn("flags", F.array_join(F.zip_with(
        F.slice("doc", F.col("begin") + F.col("lo") + 1, F.col("n")), F.slice("words", F.col("lo") + 1, F.col("n")),
        lambda a, b: F.when(a == b, F.lit("1")).otherwise(F.lit("0"))), ""))
    runs = F.regexp_replace("flags", _run_pattern(window), "2")
    whole = F.when(F.col("flags") == F.repeat(F.lit("1"), F.col("size")), F.repeat(F.lit("2"), F.col("size"))).otherwise(F.lit(""))
    rows = rows.select("key", "item", "begin", "lo", F.split(
        F.when(F.col("span") == window, runs).otherwise(whole), "").alias("marks"))
    at = F.filter(F.transform("marks", lambda c, i: F.when(c == "2", F.col("begin") + F.col("lo") + i)), lambda x: x.isNotNull())
    return rows.select("key", "item", at.alias("hits")).where(F.size("hits") > 0)


def proximity_matches(index: DataFrame, entries: DataFrame, slop: int) -> DataFrame:
    """``key, item`` where both entry terms of a window stand within ``slop``
    words of their distance in the item (in either direction)."""
    lists = index.where("term is not null").select("term", "key", "pos").distinct()
    entries = small_or_shuffled(entries).where("p2 is not null")
    width = slop + 1
    first = lists.join(entries, F.col("term") == F.col("term1")).select(
        "key", "item", "term2", (F.col("pos") - F.col("p1") + F.col("p2")).alias("due"))
    first = first.withColumn("cell", F.explode(F.array(*[F.floor(F.col("due") / width) + k for k in (-1, 0, 1)])))
    second = lists.select("key", F.col("term").alias("term2"), F.col("pos").alias("pos2"),
                          F.floor(F.col("pos") / width).alias("cell"))
    near = first.join(second, ["key", "term2", "cell"]).where(F.abs(F.col("due") - F.col("pos2")) <= slop)
    return near.select("key", "item").distinct()


def build_index(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, window entries and postings, as tables in the scratch folder."""
    table = written_small(item_table(items, window), "decontam-items")
    terms = small_or_shuffled(written_small(
        table.select(F.explode("words").alias("word")).select(term_of(F.col("word")).alias("term")).distinct(), "decontam-vocabulary"))
    entries = written_small(anchors(table, written_small(occurrences(docs, terms), "decontam-counts")), "decontam-entries")
    used = entries.select(F.explode(F.array("term1", "term2")).alias("term")).where("term is not null").distinct()
    return table, entries, written(postings(docs, used), "decontam-postings")


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The lengths ``doc_id, key, n_words`` of all documents, and the matches
    ``key, n_hit, ids`` of the texts that have any."""
    table, entries, index = build_index(docs, items, window)
    found = written(diagonals(index, entries), "decontam-diagonals")
    matches = phrase_matches(docs, table, found, window)
    names = small_or_shuffled(written_small(item_ids(items), "decontam-names"))
    hits = matches.join(names, "item", "left").groupBy("key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"),
        F.sort_array(F.collect_set("item_id")).alias("ids"))
    lengths = index.where("term is null").select("doc_id", "key", F.col("pos").cast("long").alias("n_words"))
    return lengths, written(hits, "decontam-hits")


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a hit, with their columns."""
    _, hits = scan(docs.select("doc_id", "text"), items, window)
    name = "_key"
    while name in docs.columns:
        name += "_"
    hits = small_or_shuffled(hits.select(F.col("key").alias(name)))
    return docs.withColumn(name, text_key(F.col("text"))).join(hits, name, "left_anti").select(*docs.columns)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    lengths, hits = scan(docs, items)
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return lengths.join(small_or_shuffled(hits), "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


SQL_OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(ws), {WINDOW}) AS span, unnest(list_transform(range(1, len(ws) - least(len(ws), {WINDOW}) + 2),
              lambda i: array_to_string(ws[i:i + least(len(ws), {WINDOW}) - 1], ' '))) AS w FROM b WHERE len(ws) > 0),
spans AS (SELECT DISTINCT span FROM bw),
dw AS (SELECT r, s.span, unnest(list_transform(range(1, len(ws) - s.span + 2),
              lambda i: {{'p': i, 'w': array_to_string(ws[i:i + s.span - 1], ' ')}})) AS x FROM d, spans s WHERE len(ws) >= s.span),
m AS (SELECT r, bw.span, x.p AS p, item_id FROM dw JOIN bw ON bw.span = dw.span AND bw.w = x.w),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + span)) AS q FROM m) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM (SELECT DISTINCT r, item_id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN i ON d.r = i.r
"""
