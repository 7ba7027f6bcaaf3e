from collections import Counter

import numpy as np
import pytest

from pulse.llm import minhash


def bag(text):
    w = text.encode().lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    x, y = bag(a), bag(b)
    common = sum((x & y).values())
    return common / max(1, sum(x.values()) + sum(y.values()) - common)


def brute(docs):
    """Class (smallest id) of every row by comparing all pairs of texts."""
    texts = sorted({t or "" for _, t in docs})
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if jaccard(a, b) >= minhash.THRESHOLD:
                root[find(a)] = find(b)
    ids = {}
    for d, t in docs:
        ids.setdefault(find(t or ""), []).append(d)
    best = {r: min((x for x in i if x is not None), default=None) for r, i in ids.items()}
    return sorted(((d, best[find(t or "")], len(ids[find(t or "")])) for d, t in docs), key=str)


def corpus():
    rng = np.random.default_rng(5)
    vocabulary = np.array([f"w{i}" for i in range(2000)])
    docs = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "one two"), (6, "ONE two"), (7, "one two three four five"), (8, "a " * 50), (9, "a " * 55), (10, "a " * 90)]
    n = 100
    for _ in range(12):
        base = rng.choice(vocabulary, 150).tolist()
        for edits in (0, 0, 1, 2, 3, 4, 6, 9, 15, 40):
            w = list(base)
            for at in rng.choice(len(w), edits, replace=False):
                w[at] = f"new{rng.integers(1 << 30)}"
            docs.append((n, " ".join(w)))
            n += 1
    passage = rng.choice(vocabulary, 70).tolist()
    for k in range(40):  # a shared passage alone makes no copies
        docs.append((n, " ".join(rng.choice(vocabulary, 120).tolist() + passage)))
        n += 1
    chain = rng.choice(vocabulary, 400).tolist()
    for k in range(30):  # neighbours are alike, the ends are not
        chain = chain[12:] + [f"c{k}x{j}" for j in range(12)]
        docs.append((n, " ".join(chain)))
        n += 1
    return docs + [(100, docs[20][1]), (None, docs[20][1]), (None, "only null")]


def test_weighted_agreement_is_unbiased():
    for w1, w2 in [([1] * 50 + [0] * 10, [0] * 10 + [1] * 50), ([5, 1, 7, 100, 3, 0, 2], [2, 1, 9, 60, 0, 4, 2]), ([1, 2, 3, 4, 1000], [1, 2, 3, 4, 700])]:
        a, b = np.array(w1), np.array(w2)
        truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        equal = []
        for t in range(60):
            h = minhash.mix(np.arange(len(a), dtype=np.uint64) + np.uint64(1000 * t + 7))
            doc = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
            s = minhash.signatures(doc, np.concatenate([h[a > 0], h[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 128)
            equal.append((s[0] == s[1]).mean())
        assert abs(np.mean(equal) - truth) < 0.03


def test_signature_depends_on_the_bag_only():
    texts = [b"a b c d e f g a b c d e", b"x", b"", b"a b c d e f g a b c d e"]
    doc, shingle, weight = minhash.bags(texts)
    s = minhash.signatures(doc, shingle, weight, 4, 64)
    alone = minhash.signatures(*minhash.bags([texts[0]]), 1, 64)
    assert (s[0] == s[3]).all() and (s[0] == alone[0]).all() and not s[2].any() and s[1].all()
    assert sorted(weight[doc == 0].tolist()) == [1, 1, 1, 1, 1, 1, 2]


@pytest.mark.parametrize("a,b", [("a b c d e f", "a b c d e f"), ("A b\tc", "a b c"), ("", ""), ("x " * 30, "x " * 40), ("é b c d e f g", "é b c d e f h")])
def test_similarity_is_multiset_overlap(a, b):
    assert minhash.similarity(a.encode(), b.encode()) == pytest.approx(jaccard(a, b))


def test_classes_are_those_of_all_pairs(spark):
    docs = corpus()
    frame = spark.createDataFrame([(*d, "k", True) for d in docs], "doc_id long, text string, key string, kept boolean")
    rows = minhash.near_classes(frame).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_rows) for r in rows), key=str) == brute(docs)
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({(r.class_id, r.class_rows, r.key if r.class_id is None else 0) for r in rows})
    assert all(r.doc_id == r.class_id for r in kept)
    one = minhash.keep_one(frame)
    assert one.columns == frame.columns and sorted((r.doc_id for r in one.collect()), key=str) == sorted((r.doc_id for r in kept), key=str)


def test_left_over_classes_of_a_bucket_are_compared(spark, monkeypatch):
    """With one band of one slot nearly all meet in few buckets, and the first
    text of a bucket is near few of them."""
    monkeypatch.setattr(minhash, "CHUNK", 4)
    words = [f"v{i}" for i in range(60)]
    texts = [" ".join(words[:30] + [f"p{k}q{j}" for j in range(30)]) for k in range(12)]
    texts += [t + " tail" for t in texts]
    docs = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = minhash.near_classes(frame, bands=60, rows=1).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_rows) for r in got), key=str) == brute(docs)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_classes(frame).count() == 0 and minhash.keep_one(frame).count() == 0


def test_signatures_rule_out_fewer_similar_pairs_than_the_bands_miss():
    from math import comb
    p = (1 - minhash.THRESHOLD) * (1 - 2.0 ** -minhash.SLOT_BITS)
    most, n = minhash.most_different_slots(minhash.SLOTS, minhash.THRESHOLD), minhash.SLOTS
    lost = sum(comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(most + 1, n + 1))
    missed = (1 - minhash.THRESHOLD ** minhash.ROWS) ** minhash.BANDS
    assert lost < 1e-7 and lost + missed < 3e-6


def test_no_table_grows_with_the_square_of_a_group(spark, monkeypatch):
    """Texts that share most of their words meet in the same buckets and are all
    just below the threshold: their pairs are compared without a row a pair."""
    words, made = [f"v{i}" for i in range(60)], {}
    texts = [" ".join(words + [f"p{k}q{j}" for j in range(9)]) for k in range(120)]
    texts += [t + " tail" for t in texts[:10]]
    docs = [(i, t) for i, t in enumerate(texts)]
    table = minhash.written

    def counted(df, name):
        out = table(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(minhash, "written", counted)
    got = minhash.near_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_rows) for r in got), key=str) == brute(docs)
    assert minhash.THRESHOLD > minhash.similarity(texts[0].encode(), texts[1].encode()) > 0.75
    assert max(made.values()) <= minhash.BANDS * len(docs)
