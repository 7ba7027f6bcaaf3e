import os
import zlib

import numpy as np
import pytest

from pulse.llm import bitpack, packing
from pulse.llm.tokens import ChunkEncoder, tokenizer_path
from pulse.session import scratch_path

from odd import no_docs, odd_docs  # noqa: F401


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 31, 64, 65, 1000])
def test_decompose_is_binary(n):
    doc, start, length = packing.decompose(np.array([n, 0, n]), 8)
    for d in (0, 2):
        own = length[doc == d]
        assert own.sum() == n and start[doc == d].tolist() == (np.cumsum(own) - own).tolist()
        assert all(x & (x - 1) == 0 for x in own.tolist()) and own.max() <= 8
        assert len(own) == n // 8 + bin(n % 8).count("1")
    assert not (doc == 1).any()


def test_decompose_rejects_other_lengths():
    with pytest.raises(ValueError):
        packing.decompose(np.array([3]), 6)


def test_pack_holds_every_id_once(spark, odd_docs, no_docs):
    enc = ChunkEncoder(tokenizer_path(packing.TOKENIZER))
    rows = packing.pack(odd_docs).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    want = sorted(([*x.ids, 1] for x in enc._tok.encode_batch([r.text or "" for r in odd_docs.collect()], add_special_tokens=False)), key=str)
    got, current = [], []
    for r in sorted(rows, key=lambda r: r.sequence_id):
        if r.start == 0:
            current = []
            got.append(current)
        assert r.start == len(current) and r.length == len(r.ids) == 1 << r.bucket
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        current += r.ids
    assert sorted(got, key=str) == want
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 24, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1001])
def test_bits_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << bits, n).astype(np.uint32)
    data = bitpack.pack_bits(ids, bits)
    assert len(data) == -(-n // 8) * bits
    assert (bitpack.unpack_bits(data, n, bits) == ids).all()
    # the stream is the ids' bits, lowest first
    assert "".join(f"{b:08b}"[::-1] for b in data)[:n * bits] == "".join(f"{int(i):0{bits}b}"[::-1] for i in ids)


def test_bits_for():
    assert [bitpack.bits_for(v) for v in (0, 1, 2, 3, 256, 257, 50257, 1 << 16)] == [1, 1, 1, 2, 8, 9, 16, 16]


def test_shard_random_access(tmp_path):
    ids = np.random.default_rng(1).integers(0, 50257, 3 * bitpack.BLOCK_IDS + 77).astype(np.uint32)
    w = bitpack.ShardWriter(str(tmp_path), 0, 16)
    for part in np.array_split(ids, 7):
        w.add(part, np.array([len(part)]))
    uri, n, docs = w.close()
    r = bitpack.ShardReader(uri)
    assert (n, docs, r.n) == (len(ids), 7, len(ids)) and len(r.offsets) == 4
    for a, b in [(0, 5), (65530, 65540), (0, len(ids)), (len(ids) - 3, len(ids)), (9, 9)]:
        assert (r.ids(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        bitpack.ShardWriter(str(tmp_path), 1, 4).add(np.array([16], np.uint32), np.array([1]))


def test_shards_read_back(spark, odd_docs, no_docs):
    manifest, index = bitpack.write_shards(odd_docs, scratch_path(spark, "t"))
    rows = index.join(bitpack.read_documents(manifest), ["shard", "doc"]).orderBy("start").collect()
    enc = ChunkEncoder(tokenizer_path(bitpack.TOKENIZER))
    docs = sorted(((r.doc_id is not None, r.doc_id or 0) for r in odd_docs.collect()))
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == docs
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 2
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    whole = sorted([*x.ids, 2] for x in enc._tok.encode_batch([r.text or "" for r in odd_docs.collect()], add_special_tokens=False))
    assert sorted(r.ids for r in rows) == whole
    manifest, index = bitpack.write_shards(no_docs, scratch_path(spark, "t"))
    assert index.join(bitpack.read_documents(manifest), ["shard", "doc"]).count() == 0


def test_shards_hold_the_document_ids(spark, odd_docs):
    manifest, index = bitpack.write_shards(odd_docs, scratch_path(spark, "t"), with_index=False)
    assert index.count() == 0
    rows = bitpack.read_documents(manifest).orderBy("start").collect()
    want = sorted(((r.doc_id is not None, r.doc_id or 0) for r in odd_docs.collect()))
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == want


def test_without_an_index_only_the_manifest_is_written(spark, odd_docs, monkeypatch):
    names = []
    monkeypatch.setattr(bitpack, "written", lambda df, name, f=bitpack.written: names.append(name) or f(df, name))
    folder = scratch_path(spark, "t")
    manifest, index = bitpack.write_shards(odd_docs.repartition(5), folder, with_index=False)
    assert names == ["bitpack-manifest"] and len(manifest.inputFiles()) == 1
    n = manifest.count()
    assert index.columns == ["doc_id", "shard", "doc"] and index.count() == 0
    assert bitpack.read_documents(manifest).count() == odd_docs.count()
    # nothing of the above encoded the texts again
    assert len(os.listdir(folder.removeprefix("file:"))) == n


def test_long_texts_are_cut_where_nothing_changes():
    from pulse.llm.chunked_bpe import Vocabulary
    words = Vocabulary(tokenizer_path(bitpack.TOKENIZER), special=False)
    lib = ChunkEncoder(tokenizer_path(bitpack.TOKENIZER))._tok
    texts = ["ab c. Dé\n " * 900, "x" * 5000, " " * 5000, "", "word <|endoftext|> " * 300, "日本語" * 2000, "a " + "y" * 3000 + " b " * 2000]
    ids, sizes = words.encode_texts(texts, most=1000)
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
