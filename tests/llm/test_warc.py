import struct

import zstandard

from pulse.llm import warc
from pulse.session import scratch_path


def pages(spark):
    rows = [(1, "http://a.b/x", "<p>é</p>"), (2, None, None), (3, "http://a b\r\n/", ""), (4, "u", "<p>é</p>"), (9, "u", "x" * 3_000_000),
            (7, "u", "y"), (7, "v", "y"), (None, "w", "y"), (None, "w", "z"), (None, "w", "z")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("url", "url").selectExpr("*", "1 AS row", "'d' AS digest")


def test_round_trip_and_revisits(spark):
    index = warc.write_archives(pages(spark), scratch_path(spark, "t"), frame_bytes=200)
    rows = warc.read_archives(index).collect()
    assert len(rows) == 10 and len({r.record_id for r in rows}) == 10
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in rows), key=str)
    assert got == sorted([(1, "revisit", 4, 9), (2, "revisit", 3, 0), (3, "response", None, 0), (4, "response", None, 9), (9, "response", None, 3_000_000),
                          (7, "revisit", 7, 1), (7, "response", None, 1), (None, "revisit", 7, 1), (None, "response", None, 1),
                          (None, "revisit", None, 1)], key=str)
    by = {r.page_id: r for r in rows}
    assert by[4].payload == "<p>é</p>".encode() and by[1].payload is None and by[1].payload_digest == by[4].payload_digest
    assert by[3].payload_digest == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and by[3].url == "http://a%20b%0D%0A/" and by[2].url is None
    wanted = index.where("page_id in (4, 9)").select("record_id")
    some = warc.read_records(index, wanted).collect()
    assert sorted(r.page_id for r in some) == [4, 9] and all(r.payload == by[r.page_id].payload for r in some)


def test_any_reader_unpacks_a_bundle(spark):
    index = warc.write_archives(pages(spark).coalesce(1), scratch_path(spark, "t"), frame_bytes=300)
    uri = index.first().uri
    raw = open(uri.removeprefix("file:"), "rb").read()
    assert struct.unpack("<I", raw[-4:])[0] == warc.SEEKABLE_MAGIC
    table = warc.seek_table(uri)
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(table) > 2 and len(plain) == sum(p for _, _, p in table) and plain.startswith(b"WARC/1.1\r\n")
    at = n = 0
    while at < len(plain):
        _, at = warc.parse(plain, at)
        n += 1
    assert n == 10
    frame = warc.read_frame(uri, *table[1])
    assert frame == plain[table[0][2]:table[0][2] + table[1][2]]


def test_no_pages(spark):
    index = warc.write_archives(pages(spark).limit(0), scratch_path(spark, "t"))
    assert warc.read_archives(index).count() == 0


def test_small_payloads_stay_responses(spark):
    rows = warc.choose_responses(pages(spark), least_bytes=5).collect()
    assert sorted((r.page_id for r in rows if r.refer_row is not None), key=str) == [1]
