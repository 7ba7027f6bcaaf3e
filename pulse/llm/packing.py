"""Packing by power-of-two decomposition (operator 1).

Every document is cut into pieces whose lengths are the binary digits of its
token count: as many pieces of ``max_len`` as fit, then one piece for every
set bit of the rest, longest first. Pieces of one length form a bucket, each
piece is one training sequence, so no sequence crosses documents and nothing is
padded. It is a map over documents: no shuffle, no group, and one very long
document only makes more pieces.

Defined cases: a null text is empty and gives the end id alone (one piece of
length 1); repeated rows and repeated or null ids are packed each by itself; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import ship_package
from .tokens import ChunkEncoder, WordEncoder, slices, text_encoder, tokenizer_path, with_end_ids

MAX_LEN = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 1

_encoders: dict[str, ChunkEncoder | WordEncoder] = {}


def encoder(path: str) -> ChunkEncoder | WordEncoder:
    """The worker's encoder of a vocabulary file (loaded once per process)."""
    if path not in _encoders:
        _encoders[path] = text_encoder(path)
    return _encoders[path]


def decompose(sizes: np.ndarray, max_len: int = MAX_LEN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents of ``sizes`` tokens: document index, start, length.

    ``max_len`` is a power of two. Pieces of a document are in token order.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    sizes = np.asarray(sizes, np.int64)
    digits = max_len.bit_length() - 1
    per = np.empty((len(sizes), digits + 1), np.int64)
    per[:, 0] = sizes // max_len
    for k in range(1, digits + 1):
        per[:, k] = (sizes >> (digits - k)) & 1
    lengths = max_len >> np.arange(digits + 1)
    doc = np.repeat(np.arange(len(sizes)), per.sum(axis=1))
    length = np.repeat(np.tile(lengths, len(sizes)), per.ravel())
    ends = np.cumsum(length)
    begin = ends - length
    upto = np.cumsum(sizes) - sizes
    return doc, begin - upto[doc], length


_SCHEMA = ("doc_id long, start long, length long, bucket int, ids_crc32 long, doc_tokens long{ids}")


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID,
         max_len: int = MAX_LEN, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: one row per piece, one piece per sequence.

    Returns ``doc_id, start, length, bucket (log2 of length), ids_crc32,
    doc_tokens, ids (array<int>, unless with_ids is false), sequence_id,
    offset``. ``sequence_id`` is unique, increasing within a task, and stable
    when a lost task is run again over the same split.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            keys = batch.column(0)
            for lo, hi in slices(texts):
                ids, ends = with_end_ids(*enc.encode(texts[lo:hi]), end_id)
                sizes = np.diff(ends, prepend=0)
                doc, start, length = decompose(sizes, max_len)
                stop = np.cumsum(length)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(stop.tolist(), length.tolist())]
                cols = [keys.slice(lo, hi - lo).take(pa.array(doc)), pa.array(start), pa.array(length),
                        pa.array(np.log2(length).astype(np.int32)), pa.array(crc, pa.int64()), pa.array(sizes[doc])]
                names = ["doc_id", "start", "length", "bucket", "ids_crc32", "doc_tokens"]
                if with_ids:
                    bounds = np.concatenate(([0], stop)).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, _SCHEMA.format(ids=", ids array<int>" if with_ids else ""))
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length bucket (``bucket=k``)."""
    pieces.write.partitionBy("bucket").parquet(path)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, with_ids=False)
