"""URL filters by a temporal list join (operator 6).

List entries come as dated events (an entry is added to or removed from a list).
They become validity intervals ``[valid_from, valid_to)``, and every capture is
joined as of its fetch date with the entries that were active then. An entry is a
domain (which covers its subdomains) or a host with a path prefix (whole path
segments). A capture is blocked if a blocking list holds it and no allowing list
does.

The as-of join is an equi-join on (kind, entry, year): a capture asks for the
domains and prefixes that could hold it, and an interval stands under each year
that it touches up to the last fetch, so a popular host with a long history is
compared within one year only, and the intervals of one entry never overlap.
Events are collapsed to one a day and entry before they are ordered, so the group
of an entry is bounded by the calendar. The intervals are broadcast below the
stated bound; beyond it the join shuffles narrow rows (no page content), where
Spark splits the partition of a popular host.

Defined cases: of several events of an entry on one day an addition wins; an
addition of an active entry and a removal of an inactive one change nothing; an
interval that ends on the fetch date is over; a capture without url, host or
fetch date matches nothing; events without list, entry, action or date are
ignored; host names are compared in lower case without a final dot, user info
and port; repeated captures are judged each by itself; empty tables give empty or
unblocked results; further columns of the captures are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import small_or_shuffled, written

_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:]*)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"
#: longer names are no host names and have no parent domains
_MOST_HOST = 253


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL ('' if there is none)."""
    return F.coalesce(F.rtrim(F.regexp_extract(F.lower(url), _HOST, 1), F.lit(".")), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def domain_keys(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.when(host == "", F.array().cast("array<string>")).when(F.length(host) > _MOST_HOST, F.array(host)).otherwise(parents)


def prefix_keys(host: Column, path: Column, depth: int) -> Column:
    """``host/a``, ``host/a/b``, ... down to ``depth`` path segments."""
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    n = F.least(F.size(segments), F.lit(depth))
    keys = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")))
    return F.when((host != "") & (n > 0), keys).otherwise(F.array().cast("array<string>"))


def intervals(events: DataFrame) -> DataFrame:
    """Validity of the entries of ``list, policy, kind, entry, action, day``:
    ``list, policy, kind, entry, valid_from, valid_to`` (null: still active)."""
    entry = ["list", "policy", "kind", "entry"]
    daily = (events.where("list is not null and entry is not null and day is not null and action in ('add', 'remove')")
             .groupBy(*entry, F.col("day").cast("date").alias("day")).agg((F.max(F.col("action") == "add")).alias("on")))
    order = Window.partitionBy(*entry).orderBy("day")
    changes = (daily.withColumn("was", F.coalesce(F.lag("on").over(order), F.lit(False))).where("on != was")
               .withColumn("valid_to", F.lead("day").over(order)))
    return changes.where("on").select(*entry, F.col("day").alias("valid_from"), "valid_to")


def filter_captures(captures: DataFrame, valid: DataFrame, fetched: str = "fetched") -> DataFrame:
    """``captures`` with ``blocked, n_matches, matches``.

    ``valid`` is the result of ``intervals``; ``captures`` has ``url`` and a date
    or timestamp ``fetched``. ``matches`` lists ``list:kind:entry``, sorted.
    """
    valid = written(valid, "urls-intervals")
    depth = valid.where("kind = 'prefix'").agg(F.max(F.size(F.split("entry", "/")) - 1)).first()[0] or 0
    last = captures.agg(F.max(F.col(fetched).cast("date"))).first()[0]
    until = F.coalesce(F.date_sub("valid_to", 1), F.greatest(F.lit(last).cast("date"), F.col("valid_from")))
    yearly = small_or_shuffled(written(valid.withColumn(
        "year", F.explode(F.sequence(F.year("valid_from"), F.year(until)))), "urls-years"))
    url, day = F.col("c.url"), F.col(f"c.{fetched}").cast("date")
    host = host_of(url)
    asked = F.concat(
        F.transform(domain_keys(host), lambda x: F.struct(F.lit("domain").alias("kind"), x.alias("entry"))),
        F.transform(prefix_keys(host, path_of(url), depth), lambda x: F.struct(F.lit("prefix").alias("kind"), x.alias("entry"))))
    # the capture is one struct, so its columns may have any names; the row
    # number is made and used within one plan
    each = (captures.select(F.struct(*[captures[c] for c in captures.columns]).alias("c"))
            .withColumn("row", F.monotonically_increasing_id()).withColumn("day", day).withColumn("key", F.explode_outer(asked)))
    active = ((F.col("key.kind") == yearly.kind) & (F.col("key.entry") == yearly.entry) & (F.year("day") == yearly.year)
              & (yearly.valid_from <= F.col("day")) & (yearly.valid_to.isNull() | (F.col("day") < yearly.valid_to)))
    found = F.when(yearly.list.isNotNull(), F.concat_ws(":", yearly.list, yearly.kind, yearly.entry))
    out = each.join(yearly, active, "left").groupBy("row").agg(
        F.first("c").alias("c"), F.coalesce(F.max(yearly.policy == "block"), F.lit(False)).alias("block"),
        F.coalesce(F.max(yearly.policy == "allow"), F.lit(False)).alias("allow"), F.array_sort(F.collect_set(found)).alias("hits"))
    return out.select("c.*", (F.col("block") & ~F.col("allow")).alias("blocked"),
                      F.size("hits").cast("long").alias("n_matches"), F.array_join("hits", ",").alias("matches"))


def _number(text: Column, modulus: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long"), F.lit(modulus)).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    """The tables hold no fetch times: each page gets a day of 2023 and 2024 that
    is a hash of its id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2023-01-01").cast("date"), _number(F.col("page_id").cast("string"), 730)).alias("fetched"))


def events_of(pages: DataFrame) -> DataFrame:
    """The tables hold no lists: their histories are made from the pages' hosts.

    Gambling words in a host name put it on the list ``gambling``; by the hash of
    the name some hosts and some first path segments are on ``abuse`` for parts of
    the time, and some hosts on the allowing list ``trusted``.
    """
    hosts = pages.select(host_of(F.col("url")).alias("entry")).where("entry != ''").distinct()
    sections = (pages.select(host_of(F.col("url")).alias("h"), F.get(F.filter(F.split(path_of(F.col("url")), "/"), lambda x: x != ""), F.lit(0)).alias("s"))
                .where("h != '' and s is not null").select(F.concat("h", F.lit("/"), "s").alias("entry")).distinct())

    def listed(rows: DataFrame, name: str, policy: str, kind: str, steps: list[tuple[str, int, int]]) -> DataFrame:
        days = F.array(*[F.struct(F.lit(action).alias("action"), F.date_add(F.lit("2023-01-01").cast("date"), _number(
            F.concat("entry", F.lit(f"#{i}")), span) + start).alias("day")) for i, (action, start, span) in enumerate(steps)])
        return rows.select(F.lit(name).alias("list"), F.lit(policy).alias("policy"), F.lit(kind).alias("kind"), "entry",
                           F.explode(days).alias("e")).select("list", "policy", "kind", "entry", "e.action", "e.day")

    on_off = [("add", 0, 200), ("remove", 200, 200), ("add", 400, 300)]
    return (listed(hosts.where(F.col("entry").rlike("casino|bets|win|poker")), "gambling", "block", "domain", [("add", 0, 90)])
            .unionByName(listed(hosts.where(_number(F.col("entry"), 4) == 0), "abuse", "block", "domain", on_off))
            .unionByName(listed(sections.where(_number(F.col("entry"), 5) == 0), "abuse", "block", "prefix", on_off))
            .unionByName(listed(hosts.where(_number(F.col("entry"), 10) == 1), "trusted", "allow", "domain", [("add", 100, 100), ("remove", 500, 100)])))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    out = filter_captures(captures_of(pages), intervals(events_of(pages)))
    return out.select("page_id", F.date_format("fetched", "yyyy-MM-dd").alias("fetched"), "blocked", "n_matches", "matches")


def _sql_number(text: str, modulus: int) -> str:
    return f"(('0x' || substr(md5({text}), 1, 7))::BIGINT % {modulus})::INT"


def _sql_events(rows: str, name: str, policy: str, kind: str, steps: list[tuple[str, int, int]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS list, '{policy}' AS policy, '{kind}' AS kind, entry, '{action}' AS action, "
        f"DATE '2023-01-01' + ({_sql_number(f'entry || {chr(39)}#{i}{chr(39)}', span)} + {start}) AS day FROM {rows}"
        for i, (action, start, span) in enumerate(steps))


_ON_OFF = [("add", 0, 200), ("remove", 200, 200), ("add", 400, 300)]

SQL_OP6 = rf"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, url, DATE '2023-01-01' + {_sql_number("page_id::VARCHAR", 730)} AS fetched,
                  rtrim(regexp_extract(lower(coalesce(url, '')), '{_HOST}', 1), '.') AS host,
                  list_filter(string_split(regexp_extract(coalesce(url, ''), '{_PATH}', 1), '/'), lambda x: x <> '') AS seg FROM pages),
hosts AS (SELECT DISTINCT host AS entry FROM p WHERE host <> ''),
sections AS (SELECT DISTINCT host || '/' || seg[1] AS entry FROM p WHERE host <> '' AND len(seg) > 0),
events AS ({_sql_events("hosts WHERE regexp_matches(entry, 'casino|bets|win|poker')", "gambling", "block", "domain", [("add", 0, 90)])}
  UNION ALL {_sql_events(f"hosts WHERE {_sql_number('entry', 4)} = 0", "abuse", "block", "domain", _ON_OFF)}
  UNION ALL {_sql_events(f"sections WHERE {_sql_number('entry', 5)} = 0", "abuse", "block", "prefix", _ON_OFF)}
  UNION ALL {_sql_events(f"hosts WHERE {_sql_number('entry', 10)} = 1", "trusted", "allow", "domain", [("add", 100, 100), ("remove", 500, 100)])}),
daily AS (SELECT list, policy, kind, entry, day, max(CASE WHEN action = 'add' THEN 1 ELSE 0 END) AS active FROM events GROUP BY ALL),
latest AS (SELECT r, d.list, d.policy, d.kind, d.entry, arg_max(d.active, d.day) AS active
           FROM p JOIN daily d ON d.day <= p.fetched AND p.host <> '' AND
             ((d.kind = 'domain' AND (p.host = d.entry OR p.host LIKE '%.' || d.entry)) OR
              (d.kind = 'prefix' AND len(seg) > 0 AND d.entry = p.host || '/' || seg[1]))
           GROUP BY ALL),
m AS (SELECT r, max(policy = 'block') AS b, max(policy = 'allow') AS a, count(*) AS n,
             string_agg(list || ':' || kind || ':' || entry, ',' ORDER BY list || ':' || kind || ':' || entry) AS matches
      FROM latest WHERE active = 1 GROUP BY r)
SELECT page_id, strftime(fetched, '%Y-%m-%d') AS fetched, coalesce(b AND NOT a, false) AS blocked,
       coalesce(n, 0)::BIGINT AS n_matches, coalesce(matches, '') AS matches
FROM p LEFT JOIN m ON p.r = m.r
"""
