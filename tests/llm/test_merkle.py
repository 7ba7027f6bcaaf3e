import hashlib

import pytest
from pyspark.sql import functions as F

from pulse.llm import merkle

from odd import no_docs, odd_docs  # noqa: F401


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def tree(digests):
    """Root and proof texts of a list of digests, by lists."""
    proofs, place, level = [""] * len(digests), list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, p in enumerate(place):
            lo = p // 3 * 3
            proofs[i] += "".join(level[q] for q in range(lo, min(lo + 3, len(level))) if q != p)
            place[i] = p // 3
        level = [H("".join(level[k:k + 3])) for k in range(0, len(level), 3)]
    return level[0], proofs


def brute(rows):
    """(group, order, digest) -> digest: subroot, root, proof_sha256; repeated rows as lists."""
    groups = {}
    for g, at, d in rows:
        groups.setdefault(g, []).append((at is not None, at or 0, d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in names:
        leaves = [d for _, _, d in sorted(groups[g])]
        subs[g] = (*tree(leaves), leaves)
    root, tops = tree([subs[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        sub, proofs, leaves = subs[g]
        out += [(d, sub, root, H(p + top)) for d, p in zip(leaves, proofs)]
    return sorted(out)


def spark_rows(spark, rows):
    df = spark.createDataFrame(rows, "grp string, at long, digest string").withColumn("item", F.lit(True))
    m = merkle.manifest(df)
    m = m.select("digest", "subroot", "root", merkle.digest(F.array_join(F.transform("proof", lambda s: F.concat(s["l"], s["r"])), "")).alias("p"),
                 merkle.folded(F.col("digest"), F.col("proof")).alias("folded"))
    got = m.collect()
    assert all(r.folded == r.root for r in got)
    return sorted((r.digest, r.subroot, r.root, r.p) for r in got)


@pytest.mark.parametrize("digits, sizes", [(1, [1]), (1, [1, 2, 3, 9, 10, 28]), (2, [82, 5, 1])])
def test_proofs_against_lists(spark, monkeypatch, digits, sizes):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** digits)
    names = [None, "", "b", "é", "Z", "\U0001F600", "￿"]
    rows = [(names[k], i * 7 % 1000, H(f"{k}/{i}")) for k, n in enumerate(sizes) for i in range(n)]
    assert spark_rows(spark, rows) == brute(rows)


def test_nulls_ties_and_many_groups(spark):
    rows = [(f"g{k:03d}", 1, H(str(k))) for k in range(40)] + [(None, None, H("n"))] * 3 + [("g001", None, H("x")), ("g001", 1, H("a")), ("g001", 1, H("a"))]
    assert spark_rows(spark, rows) == brute(rows)


def test_a_group_larger_than_a_block(spark):
    rows = [("big", i, H(str(i))) for i in range(3000)] + [("small", 1, H("s"))]
    assert spark_rows(spark, rows) == brute(rows)


def test_a_changed_leaf_does_not_verify(spark):
    df = spark.createDataFrame([("s", i, H(str(i))) for i in range(20)], "grp string, at long, digest string").withColumn("item", F.lit(True))
    bad = merkle.manifest(df).where(merkle.folded(merkle.digest(F.col("digest")), F.col("proof")) == F.col("root"))
    assert bad.count() == 0


def test_odd_documents(spark, odd_docs, no_docs, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = merkle.op12_merkle(spark, str(tmp_path)).collect()

    def framed(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    docs = odd_docs.collect()
    leaves = sorted(H("".join(framed(v) for v in (d.doc_id, d.source, d.lang, d.n_chars, d.text))) for d in docs)
    assert sorted(r.leaf for r in rows) == leaves and len({r.root for r in rows}) == 1
    import zlib
    changed = {d.doc_id for d in docs if d.doc_id is not None and zlib.crc32(str(d.doc_id).encode()) % 2 == 0 and "\n" in (d.text or "")}
    assert {r.doc_id for r in rows if not r.verified} == changed
    no_docs.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert merkle.op12_merkle(spark, str(tmp_path / "none")).count() == 0
