from datetime import date, datetime

from pyspark.sql import functions as F

from pulse.llm import urlfilter


def events(spark):
    day = lambda d: date(2023, 1, d) if d else None
    rows = [("l", "block", "domain", "bad.com", "add", 5), ("l", "block", "domain", "bad.com", "add", 6), ("l", "block", "domain", "bad.com", "remove", 10),
            ("l", "block", "domain", "bad.com", "remove", 12), ("l", "block", "domain", "bad.com", "add", 20), ("l", "block", "domain", "bad.com", "remove", 20),
            ("m", "block", "prefix", "ok.org/x/y", "add", 1), ("ok", "allow", "domain", "good.bad.com", "add", 1), ("l", "block", "domain", "gone.com", "remove", 3),
            ("l", "block", "domain", None, "add", 3), ("l", "block", "domain", "null.com", "add", None), (None, "block", "domain", "a.b", "add", 1), ("l", "block", "domain", "a.b", "hold", 1)]
    return spark.createDataFrame([(*r[:5], day(r[5])) for r in rows], "list string, policy string, kind string, entry string, action string, day date")


def test_intervals(spark):
    got = sorted((r.entry, r.valid_from.day, r.valid_to and r.valid_to.day) for r in urlfilter.intervals(events(spark)).collect())
    assert got == [("bad.com", 5, 10), ("bad.com", 20, None), ("good.bad.com", 1, None), ("ok.org/x/y", 1, None)]


def test_as_of_join(spark):
    cases = [("http://bad.com/", 4, ""), ("https://u:p@WWW.Bad.com.:80/q?x#y", 5, "l:domain:bad.com"), ("http://bad.com", 9, "l:domain:bad.com"), ("http://bad.com", 10, ""),
             ("http://bad.com", 25, "l:domain:bad.com"), ("http://notbad.com/", 25, ""), ("http://a.good.bad.com/z", 25, "l:domain:bad.com,ok:domain:good.bad.com"),
             ("http://ok.org/x/y/z", 2, "m:prefix:ok.org/x/y"), ("http://ok.org/x/yy", 2, ""), ("http://ok.org//x//y?q", 2, "m:prefix:ok.org/x/y"), ("mailto:x@bad.com", 25, ""),
             (None, 25, ""), ("", 25, ""), ("http://bad.com", None, ""), ("http://[::1]/", 3, ""), ("http://" + "a." * 200 + "bad.com/", 25, "")]
    rows = [(k, u, datetime(2023, 1, d, 23, 59) if d else None, want, "r", 1) for k, (u, d, want) in enumerate(cases)]
    caps = spark.createDataFrame(rows + rows[:2], "page_id long, url string, fetched timestamp, want string, list string, row int")
    out = urlfilter.filter_captures(caps, urlfilter.intervals(events(spark))).collect()
    assert len(out) == len(cases) + 2
    for r in out:
        assert r.matches == r.want, r.url
        assert r.blocked == ("l:" in r.matches or "m:" in r.matches) and "ok:" not in r.matches or "ok:" in r.matches and not r.blocked
    # later years of an open interval
    late = caps.limit(2).withColumn("fetched", F.lit("2031-06-01").cast("date"))
    assert {r.n_matches for r in urlfilter.filter_captures(late, urlfilter.intervals(events(spark))).collect()} == {1}


def test_empty_tables(spark):
    caps = spark.createDataFrame([(1, "http://bad.com", date(2023, 1, 6))], "page_id long, url string, fetched date")
    assert [r.blocked for r in urlfilter.filter_captures(caps, urlfilter.intervals(events(spark).limit(0))).collect()] == [False]
    assert urlfilter.filter_captures(caps.limit(0), urlfilter.intervals(events(spark))).count() == 0
