"""Token ids in fixed-width bit packing (operator 8).

Every id takes ``ceil(log2(vocabulary size))`` bits, little-endian bit order.
A shard file holds blocks of ``BLOCK_IDS`` ids, so that a block begins at a
whole byte and any id can be reached by arithmetic; the footer names the byte
offset of every block and the documents of the shard:

    b"PBITS2\\0\\0" | blocks | block offsets u64[] | doc starts u64[] (one more
    than documents) | doc ids i64[] | 1 for a null doc id u8[] | footer: ids u64,
    blocks u64, documents u64, block ids u32, bits u32, table offset u64, b"PBITS2\\0\\0"

Documents are dealt to shards by ranges of (doc_id, position in the input), so
shards follow each other in ascending doc_id order and a repeated id splits over
shards; each task encodes, packs and writes its own shard, and only the small
manifest (a row per shard) is summed up globally. Null ids come first.

Defined cases: a null text is empty and gives the end id alone; rows with equal
ids keep the order of the input; an empty table gives no shards.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.session import scratch_path

from .chunked_bpe import Vocabulary
from .packing import encoder
from .storage import AttemptFile, open_store, ship_package, written
from .tokens import slices, tokenizer_path, with_end_ids

MAGIC = b"PBITS2\0\0"
FOOTER = struct.Struct("<QQQIIQ8s")
BLOCK_IDS = 1 << 16
TOKENIZER = "byte_bpe_50k.json"
VOCABULARY = 50_257
END_ID = 2


def bits_for(vocabulary: int) -> int:
    """Least number of bits that holds every id below ``vocabulary``."""
    return max(1, (max(1, vocabulary) - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids side by side, ``bits`` each, lowest bit first.

    Eight ids fill exactly ``bits`` bytes; the last group is filled with zeros.
    """
    groups = -(-len(ids) // 8)
    lanes = np.zeros((groups, 8), np.uint64)
    lanes.reshape(-1)[:len(ids)] = ids
    out = np.zeros((groups, bits + 8), np.uint8)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        value = lanes[:, lane] << np.uint64(shift)
        for k in range((shift + bits + 7) // 8):
            out[:, byte + k] |= ((value >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
    return out[:, :bits].tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of ``pack_bits``."""
    groups = -(-n // 8)
    raw = np.zeros((groups, bits + 8), np.uint8)
    raw[:, :bits] = np.frombuffer(data, np.uint8, groups * bits).reshape(groups, bits)
    out = np.empty((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        value = np.zeros(groups, np.uint64)
        for k in range((shift + bits + 7) // 8):
            value |= raw[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


class ShardWriter:
    """Packs a stream of ids into one shard file; holds one block at most."""

    def __init__(self, folder: str, shard: int, bits: int):
        self.file = AttemptFile(folder, f"shard-{shard:08d}", ".pbits")
        self.file.write(MAGIC)
        self.bits, self.n = bits, 0
        self._offsets: list[int] = []
        self._rest = np.empty(0, np.uint32)
        self._sizes: list[np.ndarray] = []
        self._docs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, ids: np.ndarray, sizes: np.ndarray, doc_ids: pa.Array | None = None) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError("an id does not fit the vocabulary's bits")
        self._sizes.append(sizes)
        doc_ids = pa.nulls(len(sizes), pa.int64()) if doc_ids is None else doc_ids
        self._docs.append((doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"),
                           doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)))
        self.n += len(ids)
        ids = np.concatenate((self._rest, ids))
        whole = len(ids) // BLOCK_IDS * BLOCK_IDS
        for at in range(0, whole, BLOCK_IDS):
            self._offsets.append(self.file.write(pack_bits(ids[at:at + BLOCK_IDS], self.bits)))
        self._rest = ids[whole:]

    def close(self) -> tuple[str, int, int]:
        """URI, ids and documents of the finished shard."""
        if len(self._rest):
            self._offsets.append(self.file.write(pack_bits(self._rest, self.bits)))
        sizes = np.concatenate([np.zeros(1, np.int64), *self._sizes])
        table = self.file.write(np.array(self._offsets, "<u8").tobytes())
        self.file.write(np.cumsum(sizes).astype("<u8").tobytes())
        for column in (0, 1):
            for part in self._docs:
                self.file.write(part[column].tobytes())
        self.file.write(FOOTER.pack(self.n, len(self._offsets), len(sizes) - 1, BLOCK_IDS, self.bits, table, MAGIC))
        self.file.close()
        return self.file.uri, self.n, len(sizes) - 1


class ShardReader:
    """Random access to the ids of one shard file by byte ranges."""

    def __init__(self, uri: str):
        store, path = open_store(uri)
        self._in = store.open_input_file(path)
        size = self._in.size()
        self.n, blocks, docs, self.block_ids, self.bits, table, magic = FOOTER.unpack(
            self._in.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"not a shard file: {uri}")
        tail = self._in.read_at(8 * (blocks + 2 * docs + 1) + docs, table)
        self.offsets = np.frombuffer(tail, "<u8", blocks)
        self.starts = np.frombuffer(tail, "<u8", docs + 1, 8 * blocks).astype(np.int64)
        self.doc_ids = pa.array(np.frombuffer(tail, "<i8", docs, 8 * (blocks + docs + 1)),
                                mask=np.frombuffer(tail, np.uint8, docs, 8 * (blocks + 2 * docs + 1)).astype(bool))
        self._at, self._block = -1, np.empty(0, np.uint32)

    def block(self, k: int) -> np.ndarray:
        if k != self._at:
            n = min(self.block_ids, self.n - k * self.block_ids)
            raw = self._in.read_at(-(-n // 8) * self.bits, int(self.offsets[k]))
            self._at, self._block = k, unpack_bits(raw, n, self.bits)
        return self._block

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard."""
        parts = [np.empty(0, np.uint32)]
        for k in range(start // self.block_ids, -(-stop // self.block_ids)):
            lo = k * self.block_ids
            parts.append(self.block(k)[max(0, start - lo):stop - lo])
        return np.concatenate(parts)

    def close(self) -> None:
        self._in.close()


_whole: dict[str, object] = {}


def whole_encoder(path: str):
    """The worker's encoder of whole texts: ids of all, and the number of each.

    Byte-level files run in ``tiktoken`` without a memo; others as in packing.
    """
    if path not in _whole:
        try:
            _whole[path] = Vocabulary(path, special=False).encode_texts
        except ValueError:
            return encoder(path).encode
    return _whole[path]


def write_shards(docs: DataFrame, folder: str, tokenizer: str | None = None,
                 vocabulary: int = VOCABULARY, end_id: int = END_ID, with_index: bool = True) -> tuple[DataFrame, DataFrame]:
    """Encode and write all documents in ascending doc_id order.

    Returns the manifest ``shard, uri, n_ids, n_docs, base`` (``base``: ids of
    all earlier shards) and the document index ``doc_id, shard, doc`` (``doc``:
    position in the shard; empty unless ``with_index``, the files hold the ids
    themselves). Both are tables in the shared scratch folder.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    bits = bits_for(vocabulary)
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer, doc = TaskContext.get().partitionId(), None, 0
        schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("doc", pa.int64()),
                            ("uri", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())])
        for batch in batches:
            enc = whole_encoder(path)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            writer = writer or ShardWriter(folder, shard, bits)
            for lo, hi in slices(texts):
                ids, ends = with_end_ids(*enc(texts[lo:hi]), end_id)
                writer.add(ids, np.diff(ends, prepend=0), batch.column(0).slice(lo, hi - lo))
            n = len(texts) if with_index else 0
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(0, n), pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(doc, doc + n)),
                 pa.nulls(n, pa.string()), none, none], schema=schema)
            doc += n
        if writer:
            uri, n_ids, n_docs = writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": None, "shard": shard, "doc": None, "uri": uri, "n_ids": n_ids, "n_docs": n_docs}], schema=schema)

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("_at"))
            .repartitionByRange("doc_id", "_at").sortWithinPartitions("doc_id", "_at").select("doc_id", "text")
            .mapInArrow(run, "doc_id long, shard int, doc long, uri string, n_ids long, n_docs long"))
    if with_index:
        rows = written(rows, "bitpack-index")
    shards = rows.filter("uri is not null").select("shard", "uri", "n_ids", "n_docs")
    # a row per shard: the one global order here is over the small manifest
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    manifest = written(shards.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "bitpack-manifest")
    # without an index the manifest is all that is written, so ``rows`` must not be run again
    index = rows.filter("uri is null") if with_index else docs.sparkSession.createDataFrame([], rows.schema)
    return manifest, index.select("doc_id", "shard", "doc")


def one_task_each(table: DataFrame, *keys: str) -> DataFrame:
    """A small work list dealt so that every row is a task of its own."""
    return table.repartitionByRange(max(1, table.count()), *keys)


def read_documents(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Documents of all shards, read back from the files.

    Returns ``shard, doc, start, n_tokens, ids_crc32, doc_id`` and, unless
    ``with_ids`` is false, ``ids``.
    """
    ship_package(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = ShardReader(row["uri"])
                starts = reader.starts
                lo = 0
                while lo < len(starts) - 1:
                    hi = int(np.searchsorted(starts, starts[lo] + (1 << 20), "right")) - 1
                    hi = min(max(hi, lo + 1), len(starts) - 1)
                    ids = reader.ids(int(starts[lo]), int(starts[hi]))
                    cut = starts[lo:hi + 1] - starts[lo]
                    raw = memoryview(ids.astype("<u4").tobytes())
                    crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                    cols = [pa.array(np.full(hi - lo, row["shard"], np.int32)), pa.array(np.arange(lo, hi)),
                            pa.array(starts[lo:hi] + row["base"]), pa.array(np.diff(cut)), pa.array(crc, pa.int64()), reader.doc_ids.slice(lo, hi - lo)]
                    names = ["shard", "doc", "start", "n_tokens", "ids_crc32", "doc_id"]
                    if with_ids:
                        cols.append(pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids.astype(np.int32))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names)
                    lo = hi
                reader.close()

    schema = "shard int, doc long, start long, n_tokens long, ids_crc32 long, doc_id long" + (", ids array<int>" if with_ids else "")
    return one_task_each(manifest, "shard").mapInArrow(run, schema)


def op8_token_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest, _ = write_shards(docs, scratch_path(spark, "bitpack"), with_index=False)
    return read_documents(manifest, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
