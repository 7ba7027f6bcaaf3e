"""Byte-level BPE by reuse of content-defined chunks, and its inverse (operator 13).

A text is cut where a rolling hash of the last 32 bytes has nine zero bits,
so equal passages are cut alike wherever they lie. The inside of a chunk is
encoded once and remembered by its digest; a document that holds the chunk
again takes the ids. A cut may fall within a word, so every join is repaired: the
stretch around the cut is encoded anew and grows in both directions until it
ends, on either side, where its tokens and the chunk's must agree exactly. Such a
place is the change from a visible ASCII character to a space or line end: no
pattern word of the vocabulary goes across it, whatever the text before and after. A chunk
without such a place is swallowed and the repair goes on into the next. So
the ids are those of encoding the whole text.

Documents meet those that share chunks: rows are rebalanced by their least chunk
digest, which copies and near copies have in common, and Spark splits a partition
that grows beyond the others, so a hot group of copies only takes more tasks, each of
which encodes the group's chunks once. The memo is bounded; what it forgets is
encoded again. Texts travel compressed.

The merges run in ``tiktoken``, from the same vocabulary file (three times the speed
of ``tokenizers``, the same ids); stretches above 64 KB without a place to cut go to
``tokenizers``, whose time does not grow with the square of a word.

Defined cases: a null text is empty and has no ids; special tokens in a text are
found as the library finds them; repeated rows and repeated or null ids are
encoded each by itself; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import ship_package
from .tokens import slices, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
#: mean bytes of a chunk, and the most where the hash never cuts
CHUNK_BITS, CHUNK_MOST = 9, 1 << 16
WINDOW = 32
#: ids that a worker remembers
MEMO_IDS = 6_000_000
SLICE = 1 << 22

_GEAR = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 32, 256, dtype=np.uint32)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Encoder and decoder of a byte-level BPE file.

    Without ``special`` the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, special: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, pre = file["model"], file["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or file["normalizer"]:
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        letters = byte_letters()
        marks = {t["content"]: t["id"] for t in file["added_tokens"]}
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in model["vocab"].items() if t not in marks}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        order = [model["vocab"][m] for m in merged]
        if order != sorted(order):
            raise ValueError("ids are not in the order of the merges")
        self._fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=marks)
        self._found = set(marks) if special else set()
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = not special
        spelled = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in marks.items()}
        parts = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self._size = np.array([len(p) for p in parts], np.int64)
        self._start = np.cumsum(self._size) - self._size
        self._flat = np.frombuffer(b"".join(parts), np.uint8)

    def encode(self, raw: bytes) -> array:
        """Ids of a stretch that begins and ends where the pattern's words do."""
        text = raw.decode()
        if len(raw) > CHUNK_MOST:
            return array("I", self._whole.encode(text, add_special_tokens=False).ids)
        return array("I", self._fast.encode(text, allowed_special=self._found, disallowed_special=()))

    def encode_texts(self, texts: list[str], most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """All ids of whole texts one after the other, and the number of each.

        A text beyond ``most`` bytes is cut at places of certain agreement.
        """
        parts, sizes = [np.empty(0, np.uint32)], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if len(text) <= most // 4:
                own = [self._fast.encode_to_numpy(text, allowed_special=self._found, disallowed_special=())]
            else:
                raw = text.encode()
                places = cuts_and_places(raw)[1]
                # the last place within each stretch of ``most`` bytes, or the next one after it
                at = np.searchsorted(places, np.arange(most, len(raw), most), "right")
                ends = np.unique(np.concatenate((places[np.maximum(at - 1, 0)] if len(places) else places, [len(raw)]))).tolist()
                own = []
                for lo, hi in zip([0, *ends[:-1]], ends):
                    own.append(np.frombuffer(self._long(raw[lo:hi]), np.uint32))
            parts += own
            sizes[k] = sum(map(len, own))
        return np.concatenate(parts).astype(np.uint32, copy=False), sizes

    def _long(self, raw: bytes) -> array:
        """Ids of a part of a long text; by the library where it holds a word without end."""
        words = np.diff(cuts_and_places(raw)[1], prepend=0, append=len(raw))
        if words.max(initial=0) > CHUNK_MOST:
            return array("I", self._whole.encode(raw.decode(), add_special_tokens=False).ids)
        return array("I", self._fast.encode(raw.decode(), allowed_special=self._found, disallowed_special=()))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, one after the other."""
        size = self._size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.arange(total) + np.repeat(self._start[ids] - (ends - size), size)].tobytes()


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The worker's vocabulary (loaded once per process)."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def cuts_and_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks, the text's end included, and places of certain agreement.

    Works in slices that overlap by the window, so memory does not grow with
    the text beyond the two results.
    """
    data = np.frombuffer(raw, np.uint8)
    cuts, places = [], []
    for at in range(0, len(data), SLICE):
        lead = min(at, WINDOW)
        part = data[at - lead:at + SLICE]
        h = _GEAR[part]
        width = 1
        while width < WINDOW:
            h[width:] += h[:-width] << np.uint32(width)
            width *= 2
        found = np.flatnonzero(h[lead:] >> np.uint32(32 - CHUNK_BITS) == 0) + at + 1
        cuts.append(found[found >= WINDOW])
        after, before = part[1:], part[:-1]
        ends = np.flatnonzero(((after == 32) | (after == 10)) & (before > 32) & (before < 127)) + (1 + at - lead)
        places.append(ends[ends >= at] if lead else ends)
    cut = np.concatenate([*cuts, [len(raw)]]) if len(raw) else np.zeros(0, np.int64)
    gaps = np.diff(cut, prepend=0)
    if len(gaps) and gaps.max() > CHUNK_MOST:
        more = [np.arange(e - g + CHUNK_MOST, e, CHUNK_MOST) for e, g in zip(cut.tolist(), gaps.tolist()) if g > CHUNK_MOST]
        cut = np.unique(np.concatenate([cut, *more]))
    return cut, np.concatenate(places) if places else np.zeros(0, np.int64)


def chunk_insides(raw: bytes) -> np.ndarray:
    """Begin and end of what each chunk contributes unrepaired, a row per chunk.

    It lies between the first and the last place of agreement within the chunk;
    the stretches between the rows are the repaired joins.
    """
    cut, places = cuts_and_places(raw)
    begin = np.concatenate(([0], cut[:-1]))[:len(cut)]
    first, last = np.searchsorted(places, begin, "right"), np.searchsorted(places, cut, "left") - 1
    some = last > first
    return np.stack((places[first[some]], places[last[some]]), axis=1).astype(np.int32) if some.any() else np.zeros((0, 2), np.int32)


def _marked(docs: DataFrame) -> DataFrame:
    """Documents with their chunks: ``doc_id, packed, insides, keys, route``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=1)
        names = ["doc_id", "packed", "insides", "keys", "route"]
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts):
                packed, insides, keys, route = [], [], [], []
                for text in texts[lo:hi]:
                    raw = text.encode()
                    spans = chunk_insides(raw)
                    found = [hashlib.blake2b(raw[a:z], digest_size=16).digest() for a, z in spans.tolist()]
                    packed.append(squeeze.compress(raw))
                    insides.append(spans.tobytes())
                    keys.append(b"".join(found))
                    route.append(int.from_bytes(min(found)[:8], "big", signed=True) if found else zlib.crc32(raw))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(packed, pa.binary()), pa.array(insides, pa.binary()),
                     pa.array(keys, pa.binary()), pa.array(route, pa.int64())], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, packed binary, insides binary, keys binary, route long")


class ChunkMemo:
    """Ids of chunk insides by digest; the oldest half goes when it is full."""

    def __init__(self, words: Vocabulary, most_ids: int = MEMO_IDS):
        self._words, self._most, self._held = words, most_ids, 0
        self._ids: dict[bytes, array] = {}

    def ids(self, key: bytes, raw: bytes, begin: int, end: int) -> array:
        found = self._ids.get(key)
        if found is None:
            found = self._ids[key] = self._words.encode(raw[begin:end])
            self._held += len(found) + 40
            if self._held > self._most:
                for old in list(self._ids)[:len(self._ids) // 2]:
                    self._held -= len(self._ids.pop(old)) + 40
        return found

    def document(self, raw: bytes, insides: np.ndarray, keys: bytes) -> array:
        """Ids of a whole text: chunks from the memo, joins encoded anew."""
        out, at = array("I"), 0
        for k, (begin, end) in enumerate(insides.tolist()):
            if at < begin:
                out.extend(self._words.encode(raw[at:begin]))
            out.extend(self.ids(keys[16 * k:16 * k + 16], raw, begin, end))
            at = end
        if at < len(raw):
            out.extend(self._words.encode(raw[at:]))
        return out


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs`` (``doc_id, text``)."""
    path = tokenizer or tokenizer_path(TOKENIZER)
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        expand = zstandard.ZstdDecompressor()
        memo = ChunkMemo(vocabulary(path))
        for batch in batches:
            ids, ends, lo = array("I"), [0], 0
            doc_id, packed, insides, keys = (batch.column(k) for k in range(4))
            for k in range(batch.num_rows):
                raw = expand.decompress(packed[k].as_py())
                ids.extend(memo.document(raw, np.frombuffer(insides[k].as_py(), np.int32).reshape(-1, 2), keys[k].as_py()))
                ends.append(len(ids))
                if len(ids) > 1_000_000 or k == batch.num_rows - 1:
                    values = pa.array(np.frombuffer(ids, np.uint32).astype(np.int32) if ids else np.zeros(0, np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [doc_id.slice(lo, k + 1 - lo), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["doc_id", "ids"])
                    ids, ends, lo = array("I"), [0], k + 1

    return _marked(docs).hint("rebalance", F.col("route")).drop("route").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``encoded`` (``doc_id, ids``) with the ``text`` of the ids."""
    path = tokenizer or tokenizer_path(TOKENIZER)
    ship_package(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            lists = batch.column(1)
            lo = 0
            while lo < batch.num_rows:
                hi, held = lo, 0
                while hi < batch.num_rows and (hi == lo or held < 500_000):
                    held += len(lists[hi])
                    hi += 1
                texts = []
                for k in range(lo, hi):
                    ids = lists[k].values
                    texts.append(words.decode(ids.to_numpy()).decode("utf-8", "replace") if ids is not None else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), lists.slice(lo, hi - lo), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
                lo = hi

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def op13_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    both = decode(encode(docs))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
