import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from pulse.llm import chunked_bpe as bpe
from pulse.llm.tokens import tokenizer_path

from odd import no_docs, odd_docs  # noqa: F401


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path(bpe.TOKENIZER))


@pytest.fixture(scope="module")
def words():
    return bpe.Vocabulary(tokenizer_path(bpe.TOKENIZER))


def whole(words, text):
    raw = text.encode()
    spans = bpe.chunk_insides(raw)
    keys = b"".join(hashlib.blake2b(raw[a:z], digest_size=16).digest() for a, z in spans.tolist())
    return bpe.ChunkMemo(words).document(raw, spans, keys).tolist()


def test_same_ids_as_the_library(words, library):
    rng = random.Random(5)
    bits = ["a", " ", "\n", " ", "　", "é", "'s", "'", "12", "...", "日本", "\U0001F600", "the ", " word", "\t", "<|endoftext|>", "<|endof", "  ", "́"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 3000))) for _ in range(60)]
    texts += ["x" * 70_000, " " * 70_000 + "y", "ab " * 40_000, "no　ascii　space" * 5000, "<|endoftext|>" * 200]
    for text in texts:
        assert whole(words, text) == library.encode(text, add_special_tokens=False).ids


def test_pattern_of_all_scripts(words, library):
    points = [chr(k) for k in range(0, 0x30000, 7) if not 0xD800 <= k < 0xE000]
    for shape in ("a{0}b", "1 {0}{0} ", ".{0} \n"):
        text = "|".join(shape.format(c) for c in points)
        assert words.encode(text[:20_000].encode()).tolist() == library.encode(text[:20_000], add_special_tokens=False).ids
        assert words._fast.encode(text, allowed_special="all") == library.encode(text, add_special_tokens=False).ids


def test_cuts_depend_on_content_only(monkeypatch):
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh .") for _ in range(20_000))
    a, b = ("front " * 100 + passage).encode(), ("another front, " * 371 + passage).encode()
    ends = [{len(raw) - c for c in bpe.cuts_and_places(raw)[0].tolist()} for raw in (a, b)]
    inner = {e for e in ends[0] if e < 20_000 - bpe.WINDOW}
    assert len(inner) > 20 and inner == {e for e in ends[1] if e < 20_000 - bpe.WINDOW}
    before = [x.tolist() for x in bpe.cuts_and_places(b)]
    monkeypatch.setattr(bpe, "SLICE", 1000)
    assert [x.tolist() for x in bpe.cuts_and_places(b)] == before


def test_memo_is_bounded_and_forgets_without_harm(words, library):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcde .") for _ in range(5000)) for _ in range(10)]
    memo = bpe.ChunkMemo(words, most_ids=2000)
    for text in texts * 2:
        raw = text.encode()
        spans = bpe.chunk_insides(raw)
        keys = b"".join(hashlib.blake2b(raw[a:z], digest_size=16).digest() for a, z in spans.tolist())
        assert memo.document(raw, spans, keys).tolist() == library.encode(text, add_special_tokens=False).ids
        assert memo._held < 4000


def test_decode_is_the_librarys(words, library):
    rng = np.random.default_rng(3)
    for _ in range(50):
        ids = rng.integers(0, 50257, 200)
        assert words.decode(ids).decode("utf-8", "replace") == library.decode(ids.tolist(), skip_special_tokens=False)


def test_documents(spark, odd_docs, no_docs, library):
    rows = bpe.decode(bpe.encode(odd_docs)).collect()
    want = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids, r.text or "") for r in odd_docs.collect()]
    assert sorted(((r.doc_id, r.ids, r.text) for r in rows), key=str) == sorted(want, key=str)
    assert bpe.decode(bpe.encode(no_docs)).count() == 0


def test_query_on_given_documents(spark, library):
    sf = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, bpe.op13_chunked_bpe(spark, sf).collect())) == sorted(want)
