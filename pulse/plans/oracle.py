"""Oracle SQL (DuckDB dialect) for the query catalogue.

Each statement recomputes a catalogue query from the raw driver views with
plain SQL - same bindings, same fixed patterns - so that the Spark plan can be
checked value by value. Regular expressions are shared with the library
(RE2 and Java agree on every pattern used; see ``pulse.functions.text``).
"""

from __future__ import annotations

from pulse.functions import text as X
from pulse.operators.terms import default_stopwords
from pulse.plans import catalogue as CAT
from pulse.plans import common as CM
from pulse.schema import LABEL_COLOURS, LABELS
from pulse.sources import tables as TB


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


SCALE = lst(LABELS)
COLOURS = lst(LABEL_COLOURS)
OBS = q(TB.OBSERVED_AT)
EMPTY = "CAST([] AS VARCHAR[])"


def P6(e: str) -> str:
    return (f"(CASE WHEN {e} IS NULL THEN ' ' ELSE regexp_replace(regexp_replace(regexp_replace("
            f"{e}, {q(X.THREAD_STRIP)}, '', 'g'), {q(X.THREAD_URL)}, '', 'g'), {q(X.NEWLINES)}, ' ', 'g') END)")


def P7(e: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(coalesce({e}, ''), {q(X.COMMENT_URL)}, ' ', 'g'), "
            f"{q(X.WS_RUN)}, ' ', 'g'), {q(X.EDGE_SPACE)}, '', 'g')")


def HAS(e: str) -> str:
    return f"({e} IS NOT NULL AND regexp_matches({e}, {q(X.NWS)}))"


def EMOJI_LIST(e: str) -> str:
    raw = f"regexp_extract_all(coalesce({e}, ''), {q(X.EMOJI)})"
    return f"list_filter({raw}, lambda x, i: list_position({raw}, x) = i)"


def EMOJI_CSV(e: str) -> str:
    return f"array_to_string({EMOJI_LIST(e)}, ',')"


def TOK(e: str) -> str:
    return f"regexp_extract_all(lower(coalesce({e}, '')), {q(X.TOKEN)})"


def TERM_TOK(e: str) -> str:
    stripped = f"list_transform({TOK(e)}, lambda t: regexp_replace(t, {q(X.POSSESSIVE)}, ''))"
    return f"list_filter({stripped}, lambda t: NOT regexp_matches(t, {q(X.ALL_DIGITS)}))"


def SCORE(e: str) -> str:
    whens = " ".join(f"WHEN {q(w)} THEN {int(v)}" for w, v in sorted(CM.TEST_LEXICON.items()))
    return f"CAST(coalesce(list_sum(list_transform({TOK(e)}, lambda t: CASE t {whens} ELSE 0 END)), 0) AS BIGINT)"


def TS(seconds: str) -> str:
    return f"make_timestamp(CAST({seconds} AS BIGINT) * 1000000)"


def ISO(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00')"


def SHARE(n: str, total: str) -> str:
    return f"round_even(CAST({n} * 100 AS DOUBLE) / CAST({total} AS DOUBLE), 1)"


STOP = lst(default_stopwords())
ORIGIN = TB.ORIGIN_EPOCH

# ------------------------------------------------------------------ views
THREAD_CTES = f"""
tp AS (SELECT conv_id, role AS scope, text FROM conversations WHERE turn = 0),
tc AS (SELECT conv_id, turn, {P6('text')} AS clean FROM conversations WHERE turn > 0
       AND conv_id IN (SELECT conv_id FROM tp)),
tca AS (SELECT conv_id, string_agg(' commento:' || clean, '' ORDER BY turn) AS glued,
        list(clean ORDER BY turn) AS texts FROM tc WHERE {HAS('clean')} GROUP BY conv_id),
threads AS (
  SELECT 'reddit_post_' || tp.conv_id AS content_id, 'Reddit' AS social_media,
         tp.scope AS topic, tp.scope AS scope,
         {TS(f'{ORIGIN} + tp.conv_id * {TB.THREAD_SPACING_S}')} AS publish_date,
         {P6('tp.text')} AS post,
         (CASE WHEN {HAS(P6('tp.text'))} THEN {P6('tp.text')} ELSE '' END) || coalesce(tca.glued, '') AS label_text,
         list_concat(CASE WHEN {HAS(P6('tp.text'))} THEN [{P6('tp.text')}] ELSE {EMPTY} END,
                     coalesce(tca.texts, {EMPTY})) AS texts
  FROM tp LEFT JOIN tca USING (conv_id))"""

COMMENT_CTES = f"""
comments AS (
  SELECT 'yt_comm_' || doc_id AS content_id, 'YouTube' AS social_media, lang AS topic, source AS scope,
         {TS(f'{ORIGIN} + doc_id * {TB.COMMENT_SPACING_S}')} AS publish_date,
         {P7('text')} AS post, {P7('text')} AS label_text,
         CASE WHEN {HAS(P7('text'))} THEN [{P7('text')}] ELSE {EMPTY} END AS texts
  FROM documents)"""

LABELLED_CTES = f"""{THREAD_CTES},{COMMENT_CTES},
items AS (SELECT * FROM threads UNION ALL SELECT * FROM comments),
scored AS (SELECT *, {SCORE('label_text')} AS score, {HAS('label_text')} AS has_t FROM items),
labelled AS (
  SELECT *, CAST(CASE WHEN has_t THEN least(greatest(score, -2), 2) + 2 ELSE 2 END AS INTEGER) AS ordinal,
         NOT has_t AS defaulted
  FROM scored),
lab AS (SELECT *, ({SCALE})[ordinal + 1] AS sentiment FROM labelled),
shares AS (
  SELECT social_media, sentiment, CAST(count(*) AS BIGINT) AS n,
         CAST(sum(count(*)) OVER (PARTITION BY social_media) AS BIGINT) AS total
  FROM lab GROUP BY social_media, sentiment),
shares2 AS (SELECT *, {SHARE('n', 'total')} AS share,
            CAST(list_position({SCALE}, sentiment) - 1 AS INTEGER) AS ordinal FROM shares)"""

# ------------------------------------------------------------------ SQL
SQL: dict[str, str] = {}

SQL["normalize_thread_rows"] = f"""
WITH p AS (SELECT * FROM conversations WHERE turn = 0),
nc AS (SELECT conv_id, CAST(count(*) FILTER (WHERE turn > 0) AS BIGINT) AS k FROM conversations GROUP BY conv_id)
SELECT 'reddit_post_' || p.conv_id AS content_id, {OBS} AS observation_time, p.role AS "user",
       NULL::VARCHAR AS user_location, 'Reddit' AS social_media,
       {ISO(TS(f'{ORIGIN} + p.conv_id * {TB.THREAD_SPACING_S}'))} AS publish_date,
       NULL::VARCHAR AS geo_location, {P6('p.text')} AS comment_raw_text, {EMOJI_CSV('p.text')} AS emoji,
       'https://www.reddit.com/r/' || p.role || '/comments/' || p.conv_id || '/' AS reference_post_url,
       CAST(length(p.text) AS BIGINT) AS like_count, nc.k AS reply_count,
       0::BIGINT AS repost_count, 0::BIGINT AS quote_count, 0::BIGINT AS bookmark_count,
       'post' AS content_type, p.role AS topic, p.role AS scope
FROM p JOIN nc USING (conv_id)
UNION ALL
SELECT 'reddit_comm_' || c.conv_id || '_' || c.turn, {OBS}, c.role, NULL::VARCHAR, 'Reddit',
       {ISO(TS(f'{ORIGIN} + c.conv_id * {TB.THREAD_SPACING_S} + c.turn * {TB.TURN_SPACING_S}'))},
       NULL::VARCHAR, {P6('c.text')}, {EMOJI_CSV('c.text')},
       'https://www.reddit.com/r/' || p.role || '/comments/' || p.conv_id || '/',
       CAST(length(c.text) AS BIGINT), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 'commento', p.role, p.role
FROM conversations c JOIN p ON p.conv_id = c.conv_id WHERE c.turn > 0
"""

SQL["normalize_comment_payload"] = f"""
SELECT 'yt_comm_' || doc_id AS content_id, {OBS} AS observation_time, source AS "user",
       'YouTube' AS social_media, {ISO(TS(f'{ORIGIN} + doc_id * {TB.COMMENT_SPACING_S}'))} AS publish_date,
       {P7('text')} AS comment_raw_text, {EMOJI_CSV(P7('text'))} AS emoji,
       'https://www.youtube.com/watch?v=' || source AS reference_post_url,
       n_chars AS like_count,
       CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS reply_count,
       'commento' AS content_type, lang AS topic, source AS scope
FROM documents
"""

SQL["iso_times"] = f"""
SELECT event_id, {ISO('ts')} AS from_epoch, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS platform_text,
       {ISO('ts')} AS parsed, NULL::VARCHAR AS bad_parse, {OBS} AS observation_time
FROM events
"""

SQL["clean_thread_text"] = f"""
SELECT 'conversation' AS kind, conv_id * 100 + turn AS id, {P6('text')} AS cleaned,
       CAST(length({P6('text')}) AS INTEGER) AS n_chars FROM conversations
UNION ALL
SELECT 'page', page_id, {P6('html')}, CAST(length({P6('html')}) AS INTEGER) FROM pages
"""

SQL["clean_comment_text"] = f"""
WITH x AS (SELECT 'document' AS kind, doc_id AS id, {P7('text')} AS cleaned FROM documents
           UNION ALL SELECT 'page', page_id, {P7('html')} FROM pages)
SELECT kind, id, cleaned, substring(cleaned, 1, 100) AS preview, CAST(length(cleaned) AS INTEGER) AS n_chars FROM x
"""

_SUFFIX = "(" + lst(CAT.EMOJI_SUFFIXES) + f")[(doc_id % {len(CAT.EMOJI_SUFFIXES)} + {len(CAT.EMOJI_SUFFIXES)}) % {len(CAT.EMOJI_SUFFIXES)} + 1]"
SQL["distinct_emoji"] = f"""
WITH d AS (SELECT doc_id, text || {_SUFFIX} AS raw FROM documents)
SELECT doc_id, {EMOJI_CSV('raw')} AS emoji_raw, {EMOJI_CSV(P7('raw'))} AS emoji_cleaned,
       CAST(len({EMOJI_LIST('raw')}) AS INTEGER) AS n_emoji
FROM d
"""

SQL["platform_topic_filter"] = """
WITH p AS (SELECT conv_id, role FROM conversations WHERE turn = 0)
SELECT 'yt_comm_' || doc_id AS content_id, 'YouTube' AS social_media, lang AS topic, source AS scope
FROM documents WHERE lang = 'en'
UNION ALL
SELECT CASE WHEN c.turn = 0 THEN 'reddit_post_' || c.conv_id ELSE 'reddit_comm_' || c.conv_id || '_' || c.turn END,
       'Reddit', p.role, p.role
FROM conversations c JOIN p USING (conv_id) WHERE p.role = 'user'
"""

SQL["quarantine_reasons"] = f"""
WITH {THREAD_CTES.strip()},
b AS (SELECT tp.conv_id, {P6('tp.text')} AS post, length({P6('tp.text')}) AS n,
             (SELECT count(*) FROM tc WHERE tc.conv_id = tp.conv_id AND {HAS('tc.clean')}) AS k
      FROM tp),
f AS (SELECT conv_id, n,
             CASE WHEN n % 7 = 0 THEN 'Mastodon' ELSE 'Reddit' END AS social_media,
             CASE WHEN n % 5 = 0 THEN '  ' || chr(10) ELSE post END AS post,
             CASE WHEN n % 3 = 0 THEN 0 WHEN n % 11 = 0 THEN 0 ELSE k END AS k
      FROM b)
SELECT 'reddit_post_' || conv_id AS content_id, social_media,
       CASE WHEN social_media <> 'Reddit' THEN 'unknown_platform'
            WHEN n % 13 = 0 THEN 'bad_time'
            WHEN NOT {HAS('post')} AND k = 0 THEN 'blank_text' END AS reason,
       CAST(k AS INTEGER) AS n_text_comments
FROM f
"""

SQL["top_level_comments"] = """
WITH p AS (SELECT conv_id, role FROM conversations WHERE turn = 0)
SELECT 'reddit_comm_' || c.conv_id || '_' || c.turn AS content_id, 'reddit_post_' || c.conv_id AS post_id,
       c.turn AS position, p.role AS scope,
       'https://www.reddit.com/r/' || p.role || '/comments/' || c.conv_id || '/' AS reference_post_url
FROM conversations c JOIN p USING (conv_id) WHERE c.turn = 1
"""

SQL["top_items_per_scope"] = f"""
WITH p AS (SELECT conv_id, role FROM conversations WHERE turn = 0),
v AS (SELECT lang, source, -sum(n_chars) AS r FROM documents GROUP BY lang, source)
SELECT 'post' AS kind, role AS scope, 'reddit_post_' || conv_id AS item,
       CAST(row_number() OVER (PARTITION BY role ORDER BY conv_id) AS INTEGER) AS rank_in_scope
FROM p QUALIFY rank_in_scope <= 10
UNION ALL
SELECT 'video', lang, source, CAST(row_number() OVER (PARTITION BY lang ORDER BY r, source) AS INTEGER) AS rk
FROM v QUALIFY rk <= 3
"""

SQL["top_comments_per_thread"] = """
SELECT 'reddit_post_' || conv_id AS parent, 'reddit_comm_' || conv_id || '_' || turn AS content_id,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS pos
FROM conversations WHERE turn > 0 AND conv_id IN (SELECT conv_id FROM conversations WHERE turn = 0)
QUALIFY pos <= 20
UNION ALL
SELECT source, 'yt_comm_' || doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id // 25, place, 'yt_comm_' || doc_id) AS INTEGER) AS pos
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, doc_id // 25 ORDER BY n_chars DESC, doc_id) AS place FROM documents) QUALIFY pos <= 25
"""

_CUT = f"TIMESTAMP {q(CM.CUTOFF.replace('T', ' '))}"
SQL["limit_then_skip_seen"] = f"""
WITH n AS (SELECT * FROM events WHERE ts >= {_CUT}
           QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 10)
SELECT event_type AS scope, 'item_' || user_id AS content_id, event_id FROM n
WHERE NOT EXISTS (SELECT 1 FROM events o WHERE o.ts < {_CUT} AND o.event_type = n.event_type AND o.user_id = n.user_id)
"""

SQL["preview_shape"] = f"""
SELECT 'yt_comm_' || doc_id AS content_id, substring({P7('text')}, 1, 100) AS preview,
       (SELECT count(*) FROM documents) AS n_rows, 18::BIGINT AS n_cols
FROM documents ORDER BY doc_id LIMIT 5
"""

SQL["skip_seen"] = f"""
SELECT DISTINCT 'events' AS social_media, event_type AS scope, 'item_' || user_id AS content_id
FROM events n WHERE ts >= {_CUT}
AND NOT EXISTS (SELECT 1 FROM events o WHERE o.ts < {_CUT} AND o.event_type = n.event_type AND o.user_id = n.user_id)
"""

SQL["dedup_first"] = f"""
SELECT event_type AS scope, 'item_' || user_id AS content_id, event_id, value,
       {ISO('ts')} AS first_seen, (SELECT count(*) FROM events) AS rows_without_key
FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) = 1
"""

_NOTES = "[" + ", ".join("NULL" if n is None else q(n) for n in CAT.CSV_NOTES) + "]"
SQL["upsert_first"] = f"""
SELECT 'item_' || user_id AS content_id, event_type AS scope, {ISO('ts')} AS first_seen, event_id,
       0::BIGINT AS rows_in_missing, ({_NOTES})[event_id % {len(CAT.CSV_NOTES)} + 1] AS note
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts < {_CUT}, ts, event_id) = 1
"""

SQL["nest_threads"] = f"""
WITH {THREAD_CTES.strip()}
SELECT 'reddit_post_' || tp.conv_id AS content_id,
       CAST((SELECT count(*) FROM tc WHERE tc.conv_id = tp.conv_id) AS INTEGER) AS n_comments,
       (SELECT 'reddit_comm_' || conv_id || '_' || turn FROM tc WHERE tc.conv_id = tp.conv_id ORDER BY turn LIMIT 1) AS first_comment,
       (SELECT 'reddit_comm_' || conv_id || '_' || turn FROM tc WHERE tc.conv_id = tp.conv_id ORDER BY turn DESC LIMIT 1) AS last_comment,
       coalesce((SELECT string_agg('reddit_comm_' || conv_id || '_' || turn, ',' ORDER BY turn) FROM tc
                 WHERE tc.conv_id = tp.conv_id), '') AS comment_ids
FROM tp
"""

SQL["thread_text"] = f"""
WITH {THREAD_CTES.strip()}
SELECT content_id, label_text AS thread_text, CAST(length(label_text) AS INTEGER) AS n_chars FROM threads
"""

SQL["big_threads"] = f"""
WITH r AS (SELECT doc_id, source, {P7('text')} AS clean, min(doc_id) OVER (PARTITION BY source) AS first FROM documents),
g AS (SELECT first, count(*) - 1 AS k,
             string_agg(CASE WHEN doc_id = first THEN '' ELSE ' commento:' END || clean, '' ORDER BY doc_id) FILTER (WHERE {HAS('clean')}) AS t
      FROM r GROUP BY first),
s AS (SELECT first, k, coalesce(t, '') AS t, {SCORE("coalesce(t, '')")} AS score FROM g)
SELECT 'yt_comm_' || first AS content_id, CAST(k AS INTEGER) AS n_comments, CAST(length(t) AS INTEGER) AS n_chars,
       score, score AS flat_score,
       ({SCALE})[CASE WHEN {HAS('t')} THEN least(greatest(score, -2), 2) + 3 ELSE 3 END] AS sentiment
FROM s
"""

SQL["comment_sentiment"] = f"""
WITH {LABELLED_CTES.strip()}
SELECT content_id, score, ordinal, sentiment, defaulted,
       CAST(len({TOK('label_text')}) AS INTEGER) AS n_tokens,
       len({TOK('label_text')}) > 512 AS over_cap,
       ordinal AS ordinal_check
FROM lab WHERE social_media = 'YouTube'
"""

SQL["thread_sentiment"] = f"""
WITH {LABELLED_CTES.strip()}
SELECT content_id, score, ordinal, sentiment, defaulted, CAST(length(label_text) AS INTEGER) AS n_chars
FROM lab WHERE social_media = 'Reddit'
"""

SQL["plugin_sentiment"] = f"""
WITH {LABELLED_CTES.strip()}
SELECT content_id, ordinal, sentiment, defaulted FROM lab WHERE social_media = 'YouTube'
"""

_ANS = "(" + lst(CAT.ANSWERS) + f")[(item_id % {len(CAT.ANSWERS)} + {len(CAT.ANSWERS)}) % {len(CAT.ANSWERS)} + 1]"
_LONGEST = "(CASE WHEN regexp_extract(a, '(Very Negative|Very Positive|Negative|Neutral|Positive)', 1) = '' " \
           "THEN 'Neutral' ELSE regexp_extract(a, '(Very Negative|Very Positive|Negative|Neutral|Positive)', 1) END)"
SQL["extract_label"] = f"""
WITH b AS (SELECT item_id, {_ANS} AS a FROM benchmark)
SELECT item_id, a AS answer, {_LONGEST} AS label_longest,
       CASE WHEN contains(a, 'Very Negative') THEN 'Very Negative' WHEN contains(a, 'Negative') THEN 'Negative'
            WHEN contains(a, 'Neutral') THEN 'Neutral' WHEN contains(a, 'Positive') THEN 'Positive'
            WHEN contains(a, 'Very Positive') THEN 'Very Positive' ELSE 'Neutral' END AS label_scale_order,
       CAST(list_position({SCALE}, {_LONGEST}) - 1 AS INTEGER) AS ordinal
FROM b
"""

SQL["trained_sentiment_rules"] = f"""
WITH {LABELLED_CTES.strip()}
SELECT content_id, defaulted, true AS label_of_ordinal, true AS trained_class FROM lab WHERE social_media = 'YouTube'
"""

SQL["label_counts"] = f"""
WITH {LABELLED_CTES.strip()}
SELECT social_media, sentiment, n FROM shares2
"""

SQL["label_share"] = f"""
WITH {LABELLED_CTES.strip()}
SELECT social_media, sentiment, ordinal, n, total, share FROM shares2
"""

SQL["item_series"] = f"""
WITH {LABELLED_CTES.strip()},
s AS (SELECT social_media, row_number() OVER (PARTITION BY social_media ORDER BY publish_date, content_id) AS item,
             content_id, sentiment, ordinal FROM lab)
SELECT social_media, item, 'Item ' || item AS item_label, content_id, sentiment, ordinal,
       ({COLOURS})[ordinal + 1] AS colour FROM s
"""

SQL["texts_by_label"] = f"""
WITH {LABELLED_CTES.strip()},
t AS (SELECT social_media, sentiment, ordinal, content_id, unnest(texts) AS text FROM lab)
SELECT social_media, sentiment, ordinal, count(DISTINCT content_id) AS n_items, count(*) AS n_texts,
       CAST(sum(length(text)) AS BIGINT) AS text_chars, CAST(sum(length(text)) + count(*) - 1 AS BIGINT) AS joined_chars
FROM t GROUP BY social_media, sentiment, ordinal
"""

_TERMS = f"""
t AS (SELECT social_media, sentiment, unnest(texts) AS text FROM lab),
w AS (SELECT social_media, sentiment, unnest({TERM_TOK('text')}) AS term FROM t),
c AS (SELECT social_media, sentiment, term, count(*) AS n FROM w
      WHERE NOT list_contains({STOP}, term) GROUP BY ALL)"""

SQL["terms_by_label"] = f"""
WITH {LABELLED_CTES.strip()},{_TERMS},
r AS (SELECT social_media, sentiment, term, n,
       CAST(row_number() OVER (PARTITION BY social_media, sentiment ORDER BY n DESC, term) AS INTEGER) AS rank
       FROM c QUALIFY rank <= 200)
SELECT *, round(n / max(n) OVER (PARTITION BY social_media, sentiment), 6) AS weight FROM r
"""

SQL["collocations_by_label"] = f"""
WITH {LABELLED_CTES.strip()},{_TERMS},
tt AS (SELECT social_media, sentiment, {TERM_TOK('text')} AS l FROM t),
pr AS (SELECT social_media, sentiment, unnest(list_zip(l[1:len(l) - 1], l[2:len(l)])) AS pz FROM tt WHERE len(l) > 1),
pairs AS (SELECT social_media, sentiment, pz[1] AS w1, pz[2] AS w2 FROM pr),
c12 AS (SELECT social_media, sentiment, w1, w2, count(*) AS c12 FROM pairs
        WHERE NOT list_contains({STOP}, w1) AND NOT list_contains({STOP}, w2) GROUP BY ALL),
tot AS (SELECT social_media, sentiment, sum(n) AS n_words FROM c GROUP BY ALL),
j AS (SELECT c12.*, a.n AS c1, b.n AS c2, CAST(tot.n_words AS BIGINT) AS n_words,
             CAST(tot.n_words AS DOUBLE) AS NN, CAST(a.n AS DOUBLE) AS A, CAST(b.n AS DOUBLE) AS B,
             CAST(c12.c12 AS DOUBLE) AS AB
      FROM c12 JOIN c a ON a.social_media = c12.social_media AND a.sentiment = c12.sentiment AND a.term = c12.w1
      JOIN c b ON b.social_media = c12.social_media AND b.sentiment = c12.sentiment AND b.term = c12.w2
      JOIN tot ON tot.social_media = c12.social_media AND tot.sentiment = c12.sentiment),
s AS (SELECT *, CASE WHEN NN <= A OR NN <= B THEN 0.0 ELSE -2 * (
        (AB * ln(greatest(B / NN, 1e-10)) + (A - AB) * ln(greatest(1 - B / NN, 1e-10)))
      + ((B - AB) * ln(greatest(B / NN, 1e-10)) + ((NN - A) - (B - AB)) * ln(greatest(1 - B / NN, 1e-10)))
      - (AB * ln(greatest(AB / A, 1e-10)) + (A - AB) * ln(greatest(1 - AB / A, 1e-10)))
      - ((B - AB) * ln(greatest((B - AB) / (NN - A), 1e-10)) + ((NN - A) - (B - AB)) * ln(greatest(1 - (B - AB) / (NN - A), 1e-10)))
      ) END AS llr FROM j)
SELECT social_media, sentiment, w1, w2, c12, c1, c2, n_words, round(llr, 6) AS llr FROM s WHERE llr > 30
"""

_CASED = (f"list_filter(list_transform(regexp_extract_all(text, {q(X.TOKEN)}), "
          f"lambda t: regexp_replace(t, {q(X.POSSESSIVE_CASED)}, '')), lambda t: NOT regexp_matches(t, {q(X.ALL_DIGITS)}))")
SQL["cloud_by_label"] = f"""
WITH {LABELLED_CTES.strip()},
t AS (SELECT social_media || '/' || sentiment AS g, unnest(texts) AS text FROM lab),
tt AS (SELECT g, {_CASED} AS l FROM t),
w AS (SELECT g, w FROM (SELECT g, unnest(l) AS w FROM tt) WHERE NOT list_contains({STOP}, lower(w))),
sp AS (SELECT g, lower(w) AS k, w, count(*) AS c FROM w GROUP BY ALL),
best AS (SELECT g, k, w AS spelling FROM sp QUALIFY row_number() OVER (PARTITION BY g, k ORDER BY c DESC, w) = 1),
canon AS (SELECT x.g, x.k, coalesce(y.k, x.k) AS word, coalesce(y.spelling, x.spelling) AS spelling
          FROM best x LEFT JOIN best y ON y.g = x.g AND x.k = y.k || 's' AND NOT ends_with(x.k, 'ss')),
uni AS (SELECT c.g, c.word, c.spelling, sum(sp.c) AS n FROM sp JOIN canon c USING (g, k) GROUP BY ALL),
tot AS (SELECT g, count(*) AS nn FROM w GROUP BY g),
pr AS (SELECT g, unnest(list_zip(l[1:len(l) - 1], l[2:len(l)])) AS pz FROM tt WHERE len(l) > 1),
c12 AS (SELECT pr.g, a.word AS w1, b.word AS w2, CAST(count(*) AS DOUBLE) AS ab FROM pr
        JOIN canon a ON a.g = pr.g AND a.k = lower(pz[1]) JOIN canon b ON b.g = pr.g AND b.k = lower(pz[2]) GROUP BY ALL),
j AS (SELECT c12.g, w1, w2, ab, a.spelling || ' ' || b.spelling AS entry,
             CAST(tot.nn AS DOUBLE) AS nn, CAST(a.n AS DOUBLE) AS x, CAST(b.n AS DOUBLE) AS y
      FROM c12 JOIN uni a ON a.g = c12.g AND a.word = w1 JOIN uni b ON b.g = c12.g AND b.word = w2 JOIN tot ON tot.g = c12.g),
ph AS (SELECT g, w1, w2, entry, CAST(ab AS BIGINT) AS c FROM j WHERE nn > x AND nn > y AND -2 * (
        (ab * ln(greatest(y / nn, 1e-10)) + (x - ab) * ln(greatest(1 - y / nn, 1e-10)))
      + ((y - ab) * ln(greatest(y / nn, 1e-10)) + ((nn - x) - (y - ab)) * ln(greatest(1 - y / nn, 1e-10)))
      - (ab * ln(greatest(ab / x, 1e-10)) + (x - ab) * ln(greatest(1 - ab / x, 1e-10)))
      - ((y - ab) * ln(greatest((y - ab) / (nn - x), 1e-10)) + ((nn - x) - (y - ab)) * ln(greatest(1 - (y - ab) / (nn - x), 1e-10)))) > 30),
off AS (SELECT g, word, sum(c) AS c FROM (SELECT g, w1 AS word, c FROM ph UNION ALL SELECT g, w2, c FROM ph) GROUP BY ALL),
e AS (SELECT uni.g, spelling AS entry, false AS is_phrase, CAST(n - coalesce(off.c, 0) AS BIGINT) AS n
      FROM uni LEFT JOIN off ON off.g = uni.g AND off.word = uni.word
      UNION ALL SELECT g, entry, true, c FROM ph),
r AS (SELECT g, entry, is_phrase, n, CAST(row_number() OVER (PARTITION BY g ORDER BY n DESC, entry, is_phrase) AS INTEGER) AS rank
      FROM e WHERE n > 0 QUALIFY rank <= 200)
SELECT split_part(g, '/', 1) AS social_media, split_part(g, '/', 2) AS sentiment, rank, entry, is_phrase, n,
       round(n / max(n) OVER (PARTITION BY g), 6) AS weight FROM r
"""

_TIES = """array_to_string(list_transform(list_sort(list({{'o': ordinal, 's': sentiment}}) FILTER (WHERE {cond})),
          lambda x: x.s), ', ')"""
SQL["dominant_least"] = f"""
WITH {LABELLED_CTES.strip()},
r AS (SELECT *, max(n) OVER (PARTITION BY social_media) AS mx, min(n) OVER (PARTITION BY social_media) AS mn FROM shares2)
SELECT social_media, {_TIES.format(cond='n = mx')} AS dominant, max(share) AS dominant_share,
       {_TIES.format(cond='n = mn')} AS least, min(share) AS least_share, first(total) AS total
FROM r GROUP BY social_media
"""

_INSIGHTS = f"""
ins AS (SELECT social_media, max(share) AS peak_share,
       array_to_string(list_filter({SCALE}, lambda x: NOT list_contains(list(sentiment), x)), ', ') AS absent,
       round(sum(CASE WHEN sentiment IN ('Very Negative', 'Very Positive') THEN share ELSE 0.0 END), 1) AS extreme_share,
       sum(CASE WHEN sentiment = 'Very Negative' THEN share ELSE 0.0 END) AS very_negative_share,
       sum(CASE WHEN sentiment = 'Very Positive' THEN share ELSE 0.0 END) AS very_positive_share,
       count(*) FILTER (WHERE sentiment IN ('Very Negative', 'Very Positive')) = 2 AS both_extremes,
       max(share) > 50.0 AS majority
FROM shares2 GROUP BY social_media)"""

SQL["distribution_insights"] = f"""
WITH {LABELLED_CTES.strip()},{_INSIGHTS}
SELECT * FROM ins
"""

SQL["summary_text"] = f"""
WITH {LABELLED_CTES.strip()},{_INSIGHTS},
r AS (SELECT *, max(n) OVER (PARTITION BY social_media) AS mx, min(n) OVER (PARTITION BY social_media) AS mn FROM shares2),
dom AS (SELECT social_media, {_TIES.format(cond='n = mx')} AS dominant, {_TIES.format(cond='n = mn')} AS least,
        first(total) AS total FROM r GROUP BY social_media),
dist AS (SELECT social_media, array_to_string(list_transform(
            list_sort(list({{'k': -share, 'o': ordinal, 's': sentiment, 'v': share}})),
            lambda x: x.s || ' ' || printf('%.1f', x.v) || '%'), ', ') AS d
         FROM shares2 GROUP BY social_media)
SELECT social_media,
  '1. Distribution over ' || total || ' items: ' || d || '. ' ||
  '2. Most common: ' || dominant || '; least common: ' || least || '. ' ||
  '3. Peak: ' || dominant || ' at ' || printf('%.1f', peak_share) || '%' ||
     CASE WHEN majority THEN ' (majority)' ELSE '' END || '; ' ||
     CASE WHEN absent = '' THEN 'no label is absent' ELSE 'absent: ' || absent END || '. ' ||
  '4. Extremes: Very Negative ' || printf('%.1f', very_negative_share) || '%, Very Positive ' ||
     printf('%.1f', very_positive_share) || '%' ||
     CASE WHEN both_extremes THEN ', both present (polarised)' ELSE '' END || '.' AS summary
FROM dist JOIN dom USING (social_media) JOIN ins USING (social_media)
"""

_P = CM.PHASES
_PH = " ".join(f"WHEN publish_date >= TIMESTAMP {q(s.replace('T', ' '))} AND publish_date < TIMESTAMP {q(e.replace('T', ' '))} "
               f"THEN {q(n)}" for n, s, e in _P)
SQL["compare_phases"] = f"""
WITH {LABELLED_CTES.strip()},
ph AS (SELECT *, CASE {_PH} END AS phase FROM lab),
cnt AS (SELECT social_media, phase, sentiment, count(*) AS n FROM ph WHERE phase IS NOT NULL GROUP BY ALL),
sh AS (SELECT *, {SHARE('n', 'sum(n) OVER (PARTITION BY social_media, phase)')} AS share FROM cnt),
w AS (SELECT social_media, sentiment,
             coalesce(max(share) FILTER (WHERE phase = 'in_race'), 0.0) AS share_in_race,
             coalesce(max(share) FILTER (WHERE phase = 'post_race'), 0.0) AS share_post_race
      FROM sh GROUP BY social_media, sentiment)
SELECT *, round(share_post_race - share_in_race, 1) AS delta FROM w
"""

# a range join, the phase opened first winning
SQL["phase_shares"] = f"""
WITH {LABELLED_CTES.strip()},
p AS (SELECT doc_id, {TS(f'{TB.ORIGIN_EPOCH} + doc_id * {TB.COMMENT_SPACING_S}')} AS a, {TS(f'{TB.ORIGIN_EPOCH} + doc_id * {TB.COMMENT_SPACING_S} + n_chars')} AS b
      FROM documents WHERE doc_id % 5 = 0),
t AS (SELECT publish_date, min(doc_id) AS first FROM (SELECT DISTINCT publish_date FROM lab) JOIN p ON a <= publish_date AND publish_date < b GROUP BY publish_date),
cnt AS (SELECT social_media, 'phase_' || first AS phase, sentiment, count(*) AS n FROM lab JOIN t USING (publish_date) GROUP BY ALL)
SELECT social_media, phase, sentiment, n, {SHARE('n', 'sum(n) OVER (PARTITION BY social_media, phase)')} AS share FROM cnt
"""

SQL["cycle_metrics"] = f"""
SELECT event_type AS scope, {ISO("date_trunc('day', ts)")} AS cycle_start, count(*) AS n_items,
       count(DISTINCT user_id) AS n_distinct
FROM events GROUP BY event_type, date_trunc('day', ts)
"""

SQL["sentiment_over_time"] = f"""
WITH {LABELLED_CTES.strip()}
SELECT {ISO("date_trunc('hour', publish_date)")} AS window_start, social_media, sentiment, count(*) AS n
FROM lab GROUP BY ALL
"""

SQL["sentiment_by_place"] = f"""
WITH {LABELLED_CTES.strip()}
SELECT CASE WHEN social_media = 'YouTube' THEN topic ELSE 'unknown' END AS place, social_media, sentiment,
       count(*) AS n
FROM lab GROUP BY ALL
"""
