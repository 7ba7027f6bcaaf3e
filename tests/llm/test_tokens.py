"""The memo of words gives the ids of whole texts."""

import numpy as np
import pytest

from pulse.llm.tokens import _NOT_PLAIN, ChunkEncoder, WordEncoder, slices, text_encoder, tokenizer_path, with_end_ids

ODD = ["", " ", "  a", "a  b", "a 　b", " \x1c a", "x\n y", "a\n\nb  \n c", "it's  'll <|endoftext|> é ́x   y", "tab\t x",
       " ﻿a 1 22 \U0001F600 z", "a \x85b", "ΣΑΣ ΟΔΟΣ ", "#x # y", "one two, three. Four\nFive six\n\nSeven", "a\nB c\n", "word\x00word x",
       "Haanth.\nReoush hewh, and' the 's x's don't", "éa ñe ßü\nÀb. ça", " the the the\nthe the", "ab" * 3000, "x " * 3000, "…\nWord", "it .\nThe"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("memo", [0, 40, 1_000_000])
def test_ids_are_those_of_whole_texts(name, memo):
    enc = ChunkEncoder(tokenizer_path(name), memo)
    rng = np.random.default_rng(3)
    bits = ["the", "Thou", " ", "  ", "\n", ".", ",", "'s", "é", "Ñandú", "12", "x", "\t", "\xa0", "ing", "́", "—", "日本", "#"]
    mixed = ["".join(rng.choice(bits, 40)) for _ in range(400)]
    texts = ODD + mixed
    for _ in range(3):
        for text in texts[::7]:  # small batches, so that a small memo is full again and again
            enc.encode([text, "the thou the"])
        ids, sizes = enc.encode(texts)
        at = 0
        for text, whole, n in zip(texts, enc._tok.encode_batch(texts, add_special_tokens=False), sizes):
            assert ids[at:at + n].tolist() == whole.ids, text
            at += n
        assert at == len(ids)


def same_as_library(enc, texts):
    ids, sizes = enc.encode(texts)
    want = [e.ids for e in enc._whole.encode_batch_fast(texts, add_special_tokens=False)]
    assert sizes.tolist() == list(map(len, want))
    at = np.cumsum(sizes) - sizes
    for text, whole, lo, n in zip(texts, want, at, sizes):
        assert ids[lo:lo + n].tolist() == whole, text[:200]


def test_words_without_memo_on_every_character():
    """Each code point alone, within a word, and beside signs and figures."""
    enc = text_encoder(tokenizer_path("word_bpe_49k.json"))
    assert isinstance(enc, WordEncoder)
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    lines = ["".join(f"{c} a{c}b 'll{c}s {c}{c}1{c}. " for c in points[lo:lo + 16]) for lo in range(0, len(points), 16)]
    same_as_library(enc, lines)
    plain = [c for c in points if not _NOT_PLAIN.search(c)]
    assert len(plain) > 250
    same_as_library(enc, [f"{c}{d}A {d}e'{c}'s" for c in plain for d in plain[::9]])


@pytest.mark.parametrize("most", [3, 50, 1 << 18])
def test_words_without_memo_on_mixed_and_long_texts(most):
    enc = WordEncoder(tokenizer_path("word_bpe_49k.json"), most)
    rng = np.random.default_rng(5)
    bits = ["the", "Thou", " ", "  ", "\n", "\r\n", ".", "...", ",", "''s", "'S", "'LL", "'", "é", "Ñandú", "12", "x_y", "\t", "\xa0", "ing", "́", "—", "日本", "#", "Σ", "İ", "\x1c", "\x85"]
    same_as_library(enc, ODD + ["".join(rng.choice(bits, 40)) for _ in range(2000)])
    same_as_library(enc, ["a" * 1000 + " " + "b" * 1000, "word " * 2000, "x" * 600_000, "\n".join(["one two"] * 999)])


def test_words_without_memo_on_the_given_texts():
    import pyarrow.parquet as pq
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    same_as_library(text_encoder(tokenizer_path("word_bpe_49k.json")), [t or "" for t in texts])


def test_other_files_keep_the_memo():
    assert isinstance(text_encoder(tokenizer_path("byte_bpe_50k.json")), ChunkEncoder)


def test_no_texts_and_end_ids():
    enc = ChunkEncoder(tokenizer_path("byte_bpe_50k.json"))
    ids, sizes = enc.encode([])
    assert len(ids) == 0 and len(sizes) == 0
    ids, sizes = enc.encode(["", ""])
    out, ends = with_end_ids(ids, sizes, 7)
    assert out.tolist() == [7, 7] and ends.tolist() == [1, 2]


def test_slices_cover_all_texts():
    texts = ["a" * n for n in (5, 0, 900, 3, 3, 3)]
    spans = list(slices(texts, 6))
    assert [i for lo, hi in spans for i in range(lo, hi)] == list(range(6))
    assert list(slices([])) == []
