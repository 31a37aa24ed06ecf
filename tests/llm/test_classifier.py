import random
import zlib

import numpy as np
import pytest

from ontime.llm import classifier
from ontime.llm.common import table
from tests.llm.brute import SCHEMA, odd_documents

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def real(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


def test_held_out_accuracy_and_columns(spark, real):
    docs, labels = real
    rows = classifier.verdicts(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in judged) >= 0.97 * len(judged) > 40


def test_labels_language_and_source_are_no_inputs(spark, real):
    docs, labels = real
    few = docs.where("doc_id < 200")
    model = classifier.fit(docs, labels, classifier.learns(), sample=150, vocabulary=500)
    odd = few.selectExpr("doc_id", "text", "'zz' AS lang", "null AS source", "0 AS n_chars")
    a = {r.doc_id: r.score for r in classifier.scored(few, model).collect()}
    assert a == {r.doc_id: r.score for r in classifier.scored(odd, model).collect()}


def test_odd_documents_and_filter(spark, real):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (2, 1, "x"), (6, 1, "x"), (8, 0, "x"), (None, 1, "x"), (10, None, "x"), (-4, 1, "x")], "doc_id long, quality int, text string")
    rows = classifier.verdicts(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 8}) == 1
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1
    kept = classifier.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.predicted)


def test_no_labels_and_empty_table(spark, real):
    docs, empty = odd_documents(spark), spark.createDataFrame([], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in classifier.verdicts(docs, none).collect()} == {0.5}
    assert classifier.verdicts(empty, real[1]).collect() == [] and classifier.accepted(empty, none).collect() == []


def test_network_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 5))
    p = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = rng.random(6000) < p
    net = classifier.Network(x[:4000], y[:4000])
    assert np.mean(np.abs(net.probability(x[4000:]) - p[4000:])) < 0.08


def test_word_vectors_are_sums_of_neighbours(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["red", "blue", "cat", "dog", "x1"], k=30)) for _ in range(9)]
    docs = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "doc_id long, body binary")
    numbers, vectors = classifier.word_vectors(docs, 4, tasks=3)
    assert len(numbers) == 4 and vectors.shape == (5, classifier.DIMENSIONS)
    index = classifier.index_matrix(sorted(numbers, key=numbers.get))
    context = np.zeros(index.shape)
    count = np.zeros(5)
    for t in texts:
        own = [numbers.get(w, 0) for w in classifier.tokens(t.encode())]
        for i, w in enumerate(own):
            count[w] += 1
            for j in range(max(0, i - 2), min(len(own), i + 3)):
                if j != i:
                    context[w] += index[own[j]]
    unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    context = unit(context)
    context -= np.average(context, axis=0, weights=count + 1e-9)
    assert np.allclose(vectors, unit(context) + unit(index.astype(float)), atol=1e-5)
