import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pulse.llm import ctw

from odd import no_docs, odd_docs  # noqa: F401

TEXTS = [b"abracadabra", b"", b"ABRA cadabra abra", "é ñ".encode(), b"aaaaaaaaaa", b"the cat sat on the mat", b"the rat sat"]


def kt(a, b):
    p = 1.0
    for i in range(a):
        p *= (i + 0.5) / (i + 1)
    for j in range(b):
        p *= (j + 0.5) / (a + j + 1)
    return p


class Brute:
    """The same trees as nested dictionaries, probabilities by recursion."""

    def __init__(self, texts, depth, share):
        self.depth = depth
        self.n = defaultdict(Counter)
        for t in texts:
            t = b"\xff" * depth + t.lower() + b"\xff"
            for i in range(depth, len(t)):
                for d in range(depth + 1):
                    self.n[t[i - d:i]][t[i]] += 1
        total = sum(self.n[b""].values())
        self.kept = {c for c, v in self.n.items() if sum(v.values()) >= max(1, math.ceil(share * total))} | {b""}

    def children(self, c):
        return [k for k in self.kept if len(k) == len(c) + 1 and k.endswith(c)] if len(c) < self.depth else []

    @staticmethod
    def bits(counts, prefix):
        width = len(prefix)
        a = sum(n for b, n in counts.items() if f"{b:08b}"[:width] == prefix and f"{b:08b}"[width] == "0")
        return a, sum(n for b, n in counts.items() if f"{b:08b}"[:width] == prefix) - a

    def rest(self, c):
        out = Counter(self.n[c])
        for k in self.children(c):
            out.subtract(self.n[k])
        return out

    def weighted(self, c, prefix):
        own = kt(*self.bits(self.n[c], prefix))
        kids = self.children(c)
        if not kids:
            return own
        split = kt(*self.bits(self.rest(c), prefix))
        for k in kids:
            split *= self.weighted(k, prefix)
        return own / 2 + split / 2

    def one(self, c, context, prefix):
        a, b = self.bits(self.n[c], prefix)
        here = (b + 0.5) / (a + b + 1)
        kids = self.children(c)
        if not kids:
            return here
        stop = kt(a, b) / 2 / self.weighted(c, prefix)
        longer = context[len(context) - len(c) - 1:]
        if longer in kids:
            below = self.one(longer, context, prefix)
        else:
            a, b = self.bits(self.rest(c), prefix)
            below = (b + 0.5) / (a + b + 1)
        return stop * here + (1 - stop) * below

    def score(self, text):
        t = b"\xff" * self.depth + text.lower() + b"\xff"
        out = 0.0
        for i in range(self.depth, len(t)):
            bits = f"{t[i]:08b}"
            for k in range(8):
                p = self.one(b"", t[i - self.depth:i], bits[:k])
                out += math.log10(p if bits[k] == "1" else 1 - p)
        return out


def model_of(texts, depth, share):
    codes, counts = ctw.gram_counts(texts, depth)
    total, rows = counts.sum(), []
    for d in range(depth, -1, -1):
        for c in np.unique(codes >> 8):
            own = codes >> 8 == c
            if counts[own].sum() >= max(1, math.ceil(share * total)):
                rows += [(d, int(c), int(x & 255), int(n)) for x, n in zip(codes[own], counts[own])]
        if d:
            codes, counts = ctw.summed(codes & ((1 << 8 * d) - 1), counts)
    return ctw.Model(*np.array(rows).T, depth)


@pytest.mark.parametrize("depth,share", [(0, 0.0), (1, 0.0), (2, 0.0), (3, 0.0), (2, 0.05), (3, 0.1)])
def test_scores_are_those_of_the_recursion(depth, share):
    model, brute = model_of(TEXTS, depth, share), Brute(TEXTS, depth, share)
    probes = [b"abra", b"", b"the cat", b"zzz", "ñ".encode(), b"a" * 20]
    assert model.scores(probes) == pytest.approx([brute.score(t) for t in probes], rel=1e-5)


def test_probabilities_sum_to_one():
    p = 10.0 ** model_of(TEXTS, 3, 0.01).log10.astype(float)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_untrained_model_is_uniform():
    assert ctw.Model(*[np.empty(0, np.int64)] * 4, 3).scores([b"ab"]) == pytest.approx([-3 * math.log10(256)], rel=1e-5)


def test_query_counts_and_base(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(i, f"the cat number {i % 7} sat on mat {i}") for i in range(60)], "doc_id long, text string").unionByName(
        odd_docs.select("doc_id", "text"))
    rows = ctw.score(docs, depth=3, share=0.001, word_share=0.02).collect()
    data = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    crc = lambda d: zlib.crc32(b"" if d is None else str(d).encode())
    words = lambda t: [*t.lower().split(), b"\n"]
    seen = Counter(w for d, t in data if crc(d) % 10 for w in words(t))
    n, v = sum(seen.values()), len(seen)
    model = model_of([t for d, t in data if crc(d) % 10], 3, 0.001)
    want = [(d is None, d or 0, crc(d) % 10 == 0, len(words(t)), sum(seen[w] > 0 for w in words(t)), n, round(sum(math.log10((seen[w] + .1) / (n + .1 * (v + 1))) for w in words(t)), 6), round(float(model.scores([t])[0]), 3)) for d, t in data]
    got = [(r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 3)) for r in rows]
    assert sorted(got) == sorted(want)
    assert ctw.score(no_docs).count() == 0


def test_model_beats_shallower_ones_on_held_out_text(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").where("text is not null").orderBy("doc_id").collect()
    texts = [r.text.encode() for r in rows]
    train, test = texts[:800], texts[800:]
    flat, deep = (model_of(train, d, 0.001).scores(test).sum() for d in (0, 3))
    assert deep > 0.75 * flat  # at least a quarter fewer digits than single bytes


def test_rare_contexts_leave_a_trace_in_a_large_corpus(spark):
    common = "the cat sat on the mat and the dog lay by the door " * 40
    plain = [(i, common) for i in range(60)]
    rare = plain + [(i, "zyxwvut") for i in (1000, 1001, 1002)]  # below 2^-15 of a corpus of 100,000 bytes
    probe = next(i for i in range(5000, 6000) if zlib.crc32(str(i).encode()) % 10 == 0)

    def scored(rows, **how):
        docs = spark.createDataFrame([*rows, (probe, "zyxwvut")], "doc_id long, text string")
        return {r.doc_id: r.score for r in ctw.score(docs, **how).collect()}

    with_it, without = scored(rare), scored(plain)
    kept = [t.encode() for i, t in rare if zlib.crc32(str(i).encode()) % 10]
    assert with_it[probe] == pytest.approx(float(model_of(kept, ctw.DEPTH, 0.0).scores([b"zyxwvut"])[0]), rel=1e-5)
    assert with_it[probe] > without[probe] / 2
    # what travels to the tasks does not change a score
    assert scored(rare, most_shared=10) == pytest.approx(with_it, rel=1e-9)


@pytest.mark.parametrize("depth,share", [(0, 0.0), (1, 0.0), (3, 0.0), (5, 0.02), (6, 0.0)])
def test_tables_hold_the_model(spark, depth, share):
    rows = [(False, t) for t in TEXTS] + [(True, t) for t in (b"zzz abra", b"the cow")]
    grams = ctw.written(ctw.count_grams(spark.createDataFrame(rows, "held_out boolean, body binary"), depth), "test-grams")
    value = {r.code: r.value for r in ctw.log_probabilities(grams, depth, share).collect()}
    model = model_of(TEXTS, depth, share)
    for _, t in rows:
        assert sum(value[int(c)] for c in ctw.gram_codes([t], depth)) == pytest.approx(model.scores([t])[0], rel=1e-5)
