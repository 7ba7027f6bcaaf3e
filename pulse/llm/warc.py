"""WARC archives in seekable Zstandard bundles (operator 10).

A bundle is a WARC 1.1 file compressed in the public seekable Zstandard format:
records are grouped into frames of about ``FRAME_BYTES``, each frame is
compressed by itself, and a skippable frame with the seek table (compressed and
plain size of every frame) ends the file, so any Zstandard reader unpacks a
bundle and a record is reached by reading one frame. The record index maps
record identifiers to bundle, frame and offset within the frame.

Each task writes the records of its split into a bundle of its own, one frame in
memory at a time; pages are not shuffled. Equal payloads are found by SHA-1 and
length on narrow rows, pre-aggregated before the shuffle; only groups with more
than one record are kept and joined back, broadcast if their files are below the
stated bound and shuffled otherwise. The record with the largest page_id of a
group is the response, the others revisit it.

Defined cases: a null html is the empty payload, and empty payloads are equal
payloads too (``least_bytes`` 0); a null page_id counts as the smallest; among
rows that repeat the largest page_id with the same payload the last of the input
is the response; a null url writes no target URI; control characters in a url
are percent-encoded; an empty table gives no bundles.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.session import scratch_path

from .storage import AttemptFile, open_store, read_range, ship_package, small_or_shuffled, written

FRAME_BYTES = 1 << 20
LEVEL = 6
#: fixed values of the seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FETCHED = "1970-01-01T00:00:00Z"

_HEADER_END = b"\r\n\r\n"


def record_id(page_id: int | None, row: int) -> str:
    """Identifier of a record: its page and its row in the written table."""
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def page_of(identifier: str) -> int | None:
    page = identifier.split(":")[2]
    return int(page) if page else None


def render(page_id, row, url, payload: bytes, digest: str, response: str | None, date: str) -> bytes:
    """One record; ``response`` is the identifier that a revisit refers to.

    A revisit keeps the HTTP head, with the length of the full payload, and
    leaves out the payload.
    """
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head + (payload if response is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if response is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id, row)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if response is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {response}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _HEADER_END + block + _HEADER_END


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at ``at`` of an unpacked frame, and where the next begins.

    Of a response the payload's digest and length are taken anew from the
    payload and held against the header's.
    """
    end = data.index(_HEADER_END, at)
    head = _fields(data[at:end])
    block = end + 4
    stop = block + int(head["Content-Length"])
    body = data.index(_HEADER_END, block) + 4
    length = int(_fields(data[block:body - 4])["Content-Length"])
    kind, stated = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if kind == "response":
        payload = data[body:stop]
        if len(payload) != length or base32_sha1(payload) != stated:
            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    to = head.get("WARC-Refers-To")
    return {"record_id": head["WARC-Record-ID"], "page_id": page_of(head["WARC-Record-ID"]),
            "url": head.get("WARC-Target-URI"), "record_type": kind, "payload_bytes": length,
            "payload_digest": stated, "refers_to": page_of(to) if to else None, "payload": payload}, stop + 4


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class BundleWriter:
    """Records into independent frames, and the seek table at the end."""

    def __init__(self, file, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import zstandard
        self.file, self.frame_bytes = file, frame_bytes
        self._zip = zstandard.ZstdCompressor(level=level)
        self._open, self._held = [], 0
        self.frames: list[tuple[int, int, int]] = []

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame number of the record and its offset within the frame."""
        if self._held and self._held + len(record) > self.frame_bytes:
            self._flush()
        at = len(self.frames), self._held
        self._open.append(record)
        self._held += len(record)
        return at

    def _flush(self) -> None:
        packed = self._zip.compress(b"".join(self._open))
        self.frames.append((self.file.write(packed), len(packed), self._held))
        self._open, self._held = [], 0

    def close(self) -> None:
        if self._held:
            self._flush()
        table = b"".join(struct.pack("<II", packed, plain) for _, packed, plain in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.file.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.file.close()


def seek_table(uri: str) -> list[tuple[int, int, int]]:
    """Offset, packed and plain size of every frame, from a bundle's footer."""
    store, path = open_store(uri)
    with store.open_input_file(path) as f:
        size = f.size()
        n, flags, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or flags:
            raise ValueError(f"no seek table: {uri}")
        raw = f.read_at(8 * n, size - 9 - 8 * n)
    out, at = [], 0
    for packed, plain in struct.iter_unpack("<II", raw):
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(uri: str, offset: int, packed: int, plain: int) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(read_range(uri, offset, packed), max_output_size=max(1, plain))


def choose_responses(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` as ``page_id, url, payload, row, digest, refer_page,
    refer_row`` (the last two null for responses)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.cast("binary").alias("payload"),
                        F.monotonically_increasing_id().alias("row"),
                        F.unhex(F.sha1(payload.cast("binary"))).alias("digest"))
    groups = (rows.where(F.octet_length("payload") >= least_bytes)
              .groupBy("digest").agg(F.max(F.struct("page_id", "row")).alias("last"), F.count("*").alias("n"))
              .where("n > 1").select("digest", F.col("last.page_id").alias("last_page"), F.col("last.row").alias("last_row")))
    groups = small_or_shuffled(written(groups, "warc-groups"))
    revisit = F.col("last_row").isNotNull() & (F.col("last_row") != F.col("row"))
    return rows.join(groups, "digest", "left").select(
        "page_id", "url", "payload", "row", "digest",
        F.when(revisit, F.col("last_page")).alias("refer_page"), F.when(revisit, F.col("last_row")).alias("refer_row"))


def write_archives(pages: DataFrame, folder: str, date: str = FETCHED, least_bytes: int = 0,
                   frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write every page as a record; returns the record index.

    The index has ``record_id, page_id, uri, frame, offset`` (within the
    frame), a table in the shared scratch folder.
    """
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, uri = None, ""
        for batch in batches:
            out = []
            for page, url, payload, row, digest, refer, refer_row in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    file = AttemptFile(folder, f"pages-{TaskContext.get().partitionId():08d}", ".warc.zst")
                    writer, uri = BundleWriter(file, frame_bytes), file.uri
                to = None if refer_row is None else record_id(refer, refer_row)
                frame, at = writer.add(render(page, row, url, payload, base64.b32encode(digest).decode(), to, date))
                out.append({"record_id": record_id(page, row), "page_id": page, "uri": uri, "frame": frame, "offset": at})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                    [("record_id", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()),
                     ("frame", pa.int32()), ("offset", pa.int64())]))
        if writer:
            writer.close()

    return written(choose_responses(pages, least_bytes).mapInArrow(
        run, "record_id string, page_id long, uri string, frame int, offset long"), "warc-index")


_RECORD = ("record_id string, page_id long, url string, record_type string, payload_bytes long, "
           "payload_digest string, refers_to long")
_ARROW = [("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
          ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]


def _read(work: DataFrame, with_payload: bool, chosen: bool) -> DataFrame:
    """Records of frames (``uri, frame``), or of ``offsets`` within them."""
    ship_package(work.sparkSession)
    fields = _ARROW if with_payload else _ARROW[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_of, table = None, []
        for batch in batches:
            for todo in batch.to_pylist():
                if table_of != todo["uri"]:
                    table_of, table = todo["uri"], seek_table(todo["uri"])
                data = read_frame(todo["uri"], *table[todo["frame"]])
                out, at = [], 0
                wanted = sorted(todo["offsets"]) if chosen else None
                while (wanted if chosen else at < len(data)):
                    record, at = parse(data, wanted.pop(0) if chosen else at)
                    out.append(record if with_payload else {k: record[k] for k, _ in fields})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=pa.schema(fields))

    return work.mapInArrow(run, _RECORD + (", payload binary" if with_payload else ""))


def read_archives(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the bundles that an index names."""
    frames = index.select("uri", "frame").distinct()
    n = index.select("uri").distinct().count()
    return _read(frames.repartitionByRange(max(1, n), "uri", "frame").sortWithinPartitions("uri", "frame"),
                 with_payload, chosen=False)


def read_records(index: DataFrame, ids: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the identifiers in ``ids`` (``record_id``) by random access.

    Only frames that hold a wanted record are read.
    """
    work = index.join(ids.select("record_id").distinct(), "record_id").groupBy("uri", "frame").agg(
        F.collect_set("offset").alias("offsets"))
    return _read(work, with_payload, chosen=True)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    index = write_archives(pages, scratch_path(spark, "warc"))
    return read_archives(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: base32 of the digest: the 160 bits of the hexadecimal form in groups of five
SQL_OP10 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM p),
b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i:
        ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
        [instr('0123456789abcdef', substr(hex, i, 1))]), 'string_agg', '') AS bits FROM d),
g AS (SELECT *, list_aggregate(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT
                 + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT
                 + substr(bits, 5 * i + 5, 1)::INT, 1)), 'string_agg', '') AS payload_digest,
        max(page_id) OVER (PARTITION BY hex, payload_bytes) AS last_page FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last_page THEN NULL ELSE last_page END AS refers_to
FROM g
"""
