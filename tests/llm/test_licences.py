import numpy as np
import pytest

from pulse.llm import licences

from odd import no_docs, odd_docs  # noqa: F401


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(2)
    words = [f"{a}{b}{c}" for a in ("the", "on", "ing", "er") for b in ("sh", "ti", "ha", "") for c in ("ed", "an", "or", "ly")]
    return licences.train([" ".join(rng.choice(words, 30)) for _ in range(400)])


def test_held_out_accuracy(model):
    """Paragraphs that other draws made: at least 95 % of the families right."""
    rng = np.random.default_rng(99)
    right = total = wrong = 0
    for f, notices in licences.TEMPLATES.items():
        for t in notices:
            for text in licences.variants(t, licences.TALK, rng, 12):
                _, hits = model.hits([text.encode()])
                total += 1
                right += any(h[2] == f for h in hits)
                wrong += any(h[2] not in (f, "unknown") for h in hits)
    assert right >= 0.9 * total and wrong <= 0.03 * total


def test_unknown_and_none(model):
    seen = lambda t: [h[2] for h in model.hits([t.encode()])[1]]
    assert seen("Released under the MIT License.") == ["mit"]
    assert seen("Distributed under the Eclipse Public License v2.0.") == ["unknown"]
    assert [seen(t) for t in licences.TALK] == [[]] * len(licences.TALK)
    assert seen("In. " * 200) == [] and seen("") == [] and seen("... ---") == []


def test_lines_and_texts_are_told_apart():
    text, line, size, grams, count = licences.features([b"one two three\n\nfour, five", b"", b"\n\n", b"six"])
    assert text.tolist() == [0, 0, 3] and line.tolist() == [0, 2, 0] and count.tolist() == [3, 2, 1] and size.tolist() == [5, 3, 1]
    alone = licences.features([b"four five"])[3]
    assert grams[5:8].tolist() == alone.tolist()
    assert len(licences.features([])[0]) == 0


def test_scan_keeps_all_rows(spark, model, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text", "_key").union(spark.createDataFrame(
        [(50, "intro\nLicensed under CC BY-NC 4.0.\nmore\nReleased under the MIT License.", "k")], "doc_id long, text string, k string"))
    rows = licences.scan(docs, model).collect()
    assert len(rows) == docs.count()
    hit = [r for r in rows if r.doc_id == 50][0]
    assert hit.n_paragraphs == 4 and [(h.paragraph, h.family) for h in hit.hits] == [(1, "cc-by-nc"), (3, "mit")]
    assert all(not r.hits for r in rows if r.doc_id != 50)
    assert licences.scan(no_docs, model).count() == 0
    assert licences.corpus_paragraphs(no_docs) == []


def test_training_without_a_corpus():
    assert licences.train([]).hits([b"Released under the MIT License."])[1][0][2] == "mit"


def test_other_licences_are_not_confirmed_by_boilerplate(model):
    seen = lambda t: [h[2] for h in model.hits([t.encode()])[1]]
    for t in ["Released under the Unlicense.", "Licensed under the GNU Lesser General Public License.",
              "You may use this under the GNU Lesser General Public License.", "Released under the WTFPL.", "Licensed under the EUPL."]:
        assert set(seen(t)) <= {"unknown"}, t
    assert seen("This work is licensed under the GNU General Public License, version 3.") == ["gpl"]


#: notices of the given documents and their families, told by plain search
LINES = {"Apache License": "apache", "MIT License": "mit", "GNU General Public License": "gpl", "CC BY-NC": "cc-by-nc", "All rights reserved": "proprietary"}


def test_licence_lines_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {}
    for r in docs.collect():
        for i, line in enumerate((r.text or "").split("\n")):
            for words, family in LINES.items():
                if words in line:
                    want[r.doc_id, i] = family
    trained = licences.train(licences.corpus_paragraphs(docs))
    # lines without a word are no paragraphs but keep their numbers
    got = {(r.doc_id, h.paragraph): h.family for r in licences.scan(docs, trained).collect() for h in r.hits}
    assert len(want) > 30 and set(want.values()) == set(LINES.values())
    assert {k: f for k, f in got.items() if f != "unknown"} == want
    assert len(got) - len(want) <= 0.05 * len(want)


def test_frequent_lines_do_not_crowd_out_the_sample(spark):
    from pyspark.sql import functions as F
    few = spark.range(3000).select(F.concat(F.lit("line of text number "), F.col("id").cast("string")).alias("text"))
    many = spark.range(10000).select(F.lit("a line that everybody has").alias("text"))
    sample = licences.corpus_paragraphs(few, 200)
    assert len(sample) == 200 == len(set(sample))
    both = licences.corpus_paragraphs(few.union(many), 200)
    assert len(both) == 200 and len(set(sample) & set(both)) >= 199
    assert licences.corpus_paragraphs(few.limit(150), 200) == licences.corpus_paragraphs(few.limit(150), 500)
    assert licences.corpus_paragraphs(spark.createDataFrame([("x" * 3000 + "\nshort one",)], "text string")) == ["short one"]
