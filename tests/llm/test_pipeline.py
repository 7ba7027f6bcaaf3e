"""Stages of the pipeline against their brute-force versions."""

import importlib.util

import corpus_pipeline as pipeline
from test_decontam import brute as leaks
from test_minhash import brute as copies

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality_rules", "minhash_dedup", "decontamination", "packing"]
    out, kept = docs, []
    for name, stage in pipeline.STAGES[:-1]:
        out = pipeline.written(stage(spark, out, SF), "test-stage")
        assert out.columns == docs.columns, name
        kept.append([(r.doc_id, r.text) for r in out.collect()])
    good, single, clean = kept
    from test_quality import brute as measures
    assert all(not measures(t)[5] for _, t in good)
    assert {d for d, _ in single} == {d for d, c, _ in copies(good) if d == c} and len(single) == len({d for d, _ in single})
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {d for d, _ in clean} == {d for d, _, n, _ in leaks(single, items) if not n}
    rows = pipeline.run(spark, SF).collect()
    tokens = {}
    for r in rows:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == {r.doc_id: r.doc_tokens for r in rows} and set(tokens) == {d for d, _ in clean}


def test_repeated_and_null_rows_pass_through(spark):
    docs = spark.createDataFrame([(1, None, "en"), (None, "x " * 80, None), (2, " ".join(f"w{i}" for i in range(90)), "en"),
                                  (2, " ".join(f"w{i}" for i in range(90)), "en"), (3, " ".join(f"w{i}" for i in range(90)), None)], "doc_id long, text string, lang string")
    out = docs
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, out, SF)
    assert [(r.doc_id, r.lang) for r in out.collect()] == [(2, "en")]
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_entry_registers_all():
    import __spark_entry__ as entry
    names = [q for q in entry.queries() if q.startswith("op") and q[2].isdigit()]
    assert len(names) == 13 and "pipeline" in entry.queries()
    assert importlib.util.find_spec("pulse.llm") is not None

