from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.tables import documents, prose, rows
from tidelake.llm import weak_quality

TABLES = "/root/testdata/sf0.01"


def test_em_recovers_accuracies():
    rng = np.random.default_rng(2)
    good = rng.random(40_000) < 0.85
    right = np.array([0.3, 0.4, 0.5, 0.35, 0.45, 0.6, 0.5, 0.4])  # against a bad text
    against = np.where(good[:, None], rng.random((40_000, 8)) < 0.001, rng.random((40_000, 8)) < right)
    silent = rng.random((40_000, 8)) < 0.2
    cast = np.where(silent, 1, np.where(against, 0, 2))
    patterns, inverse, counts = np.unique(
        weak_quality.pattern(cast), return_inverse=True, return_counts=True)
    table, posterior = weak_quality.expectation_maximisation(patterns, counts)
    assert np.abs(table[0, :, 0] - right).max() < 0.05
    assert ((posterior[inverse] > 0.5) == good).mean() > 0.97
    assert (weak_quality.unpattern(weak_quality.pattern(cast[:50])) == cast[:50]).all()


def test_measures_against_plain_python():
    texts = [r[1] for r in rows()] + ["AA AA bb, ** 12 **", "Éé É 1"]
    words = weak_quality.words_of(pa.array(texts, pa.string()))
    found = weak_quality.measures(words)
    for n, text in enumerate(texts):
        w = [x for x in (text or "").split(" ") for x in x.split()] if text else []
        if not w or any(ord(c) > 0x2000 for c in text):
            continue
        chars, letters = sum(map(len, w)), sum(c.isalpha() for x in w for c in x)
        assert abs(found["word_length"][n] - chars / len(w)) < 1e-9
        assert abs(found["letter_ratio"][n] - letters / chars) < 1e-9
        assert abs(found["stutter_ratio"][n]
                   - sum(a == b for a, b in zip(w, w[1:], strict=False)) / len(w)) < 1e-9
        assert abs(found["lone_mark_ratio"][n]
                   - sum(not any(c.isalnum() for c in x) for x in w) / len(w)) < 1e-9


def test_scorer_is_the_same_for_a_text_alone_and_in_company():
    texts = pa.array([r[1] for r in rows()], pa.string())
    doc, feature, value = weak_quality.features(weak_quality.words_of(texts))
    for n in range(len(texts)):
        _, f, v = weak_quality.features(weak_quality.words_of(texts.slice(n, 1)))
        assert feature[doc == n].tolist() == f.tolist()
        assert np.allclose(value[doc == n], v)


def test_awkward_rows(spark):
    junk = [(2000 + n, "*** " + "BAD$$$ !!! " * 40, "en", "j", 3, 7, 7, "x", "y", 8, 9, "z")
            for n in range(10)]
    docs = documents(spark).unionByName(spark.createDataFrame(junk, documents(spark).schema))
    found = weak_quality.classify(docs).collect()
    assert len(found) == len(rows()) + 10
    for r in found:
        text = r["document"]["text"]
        if not (text or "").strip():
            assert r["score"] == 0 and not r["kept"]
        elif r["document"]["doc_id"] is not None and r["document"]["doc_id"] >= 2000:
            assert not r["kept"] and r["posterior"] < 0.5
        elif r["document"]["source"] == "hot":
            assert r["kept"] and r["posterior"] > 0.5
    kept = weak_quality.good_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in found)


@pytest.mark.parametrize("table", [TABLES])
def test_against_given_labels(spark, table):
    """The labels are not used to learn; they show what was learnt."""
    docs = spark.read.parquet(f"{table}/documents.parquet")
    labels = spark.read.parquet(f"{table}/labels.parquet")
    found = weak_quality.classify(docs).selectExpr("document.doc_id", "kept").join(
        labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in found}
    assert n.get((1, True), 0) >= 0.99 * (n.get((1, True), 0) + n.get((1, False), 0))
    assert n.get((0, False), 0) >= 0.95 * (n.get((0, True), 0) + n.get((0, False), 0))


def test_empty(spark):
    empty = documents(spark, empty=True)
    assert weak_quality.classify(empty).collect() == []
    assert weak_quality.good_documents(empty).collect() == []
    assert weak_quality.good_documents(
        spark.createDataFrame([(1, prose(1, 50))], "doc_id long, text string")).count() <= 1
