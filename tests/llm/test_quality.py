import math
import random
import zlib

import numpy as np
import pytest
from messy import LONG, documents, words

from starfold.llm import quality
from starfold.llm.queries import op11_ngram_quality

SF = "/root/testdata/sf0.001"


def junk(seed, count=60):
    draws = random.Random(seed)
    kind = seed % 3
    plain = words(seed, count).split()
    if kind == 0:
        return " ".join(f"{word.upper()}!!" for word in plain)
    if kind == 1:
        return " ".join(word + draws.choice(["***", "$$$"]) for word in plain)
    return " ".join(word for word in plain[:8] for _ in range(9))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, words(i, 60) if i % 2 else junk(i)) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, i % 2) for i in range(240)], "doc_id long, quality int")


def plain_features(text):
    """The definition, n-gram by n-gram."""
    pieces = text.encode().split()
    plain = [zlib.crc32(word) for word in pieces]
    forms = [
        quality.REPEATED if i and pieces[i] == pieces[i - 1] else zlib.crc32(quality.form(word)) for i, word in enumerate(pieces)
    ]
    grams = [(1, (c,)) for c in plain] + [(3, (c,)) for c in forms]
    for kind, series, n in ((2, plain, 2), (4, forms, 2), (5, forms, 3)):
        grams += [(kind, tuple(series[i : i + n])) for i in range(len(series) - n + 1)]
    counts = {}
    for kind, codes in grams:
        total = kind
        for code in codes:
            total = (total ^ code) * 0x9E3779B1 % 2**32
            total ^= total >> 15
        at = (total * 0x85EBCA6B % 2**32) >> 14
        counts[at] = counts.get(at, 0) + 1
    values = {at: 1 + math.log(n) for at, n in counts.items()}
    length = math.sqrt(sum(v * v for v in values.values())) or 1
    return {at: v / length for at, v in values.items()} | {quality.BINS: 1.0}


@pytest.mark.parametrize("stretch", [1, 7, 50, 1 << 20])
@pytest.mark.parametrize("text", ["", " \n", "one", "a a a a b a a", "THE!! THE!! end", junk(3) + " " + junk(5), "é Ü\x00x \x0bnaïve"])
def test_features_are_those_of_the_definition_however_cut(monkeypatch, text, stretch):
    monkeypatch.setattr(quality, "STRETCH", stretch)
    at, values = quality.features(text, quality.Codes())
    assert (np.diff(at) > 0).all()
    want = plain_features(text)
    assert dict(zip(at.tolist(), values.tolist())) == pytest.approx(want)


def test_forms():
    assert [quality.form(w) for w in (b"THE!!", b"Thre***", b"|", b"a1b22", "Été".encode())] == [b"A!", b"Aa*", b"|", b"a0a0", b"a"]


def test_updates_are_those_of_the_definition():
    learner, rows = quality.Learner(), [([1, 5], [0.6, 0.8], 1), ([5, 7], [1.0, 0.5], 0), ([1], [1.0], 1), ([5], [1.0], 0)]
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0)) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for at, values, label in rows:
        learner.learn(np.array(at), np.array(values), label)
        weights = {i: weight(i) for i in at}
        chance = 1 / (1 + math.exp(-sum(weights[i] * v for i, v in zip(at, values))))
        for i, v in zip(at, values):
            slope = (chance - label) * v
            pace = (math.sqrt(n.get(i, 0) + slope**2) - math.sqrt(n.get(i, 0))) / quality.ALPHA
            z[i], n[i] = z.get(i, 0) + slope - pace * weights[i], n.get(i, 0) + slope**2
    for i in (1, 5, 7, 9):
        assert learner.weights(np.array([i]))[0] == pytest.approx(weight(i))
    assert learner.weights(np.array([1]))[0] > 0 > learner.weights(np.array([5]))[0]


def test_held_out_texts(spark, labelled):
    weights = quality.fit(*labelled, "quality")
    fresh = spark.createDataFrame([(i, words(i, 50) if i % 2 else junk(i, 50)) for i in range(1000, 1100)], "doc_id long, text string")
    found = quality.score(fresh, weights).collect()
    assert all(row.predicted == row.doc_id % 2 and (row.score >= 0.5) == bool(row.predicted) for row in found)


def test_learning_does_not_depend_on_partitions(labelled, monkeypatch):
    docs, labels = labelled
    monkeypatch.setattr(quality, "LEARNER_ROWS", 64)
    first = quality.fit(docs, labels, "quality")
    again = quality.fit(docs.repartition(7).orderBy("text"), labels.repartition(3), "quality")
    assert np.count_nonzero(first) > 100 and (first == again).all()


def test_a_sample_is_about_as_large_as_asked(labelled):
    docs, labels = labelled
    sampled, count = quality.sample(docs, labels, "quality", "doc_id", "text", 60)
    assert count == 60 and 30 < sampled.count() < 90


def test_awkward_labels(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, 0), (2, 1), (2, 0), (2, None), (None, 1), (9, 1)], "doc_id long, quality int")
    rows, _ = quality.sample(docs, labels, "quality", "doc_id", "text", 100)
    assert sorted(tuple(row) for row in rows.select("__key", "__label", "__text").collect()) == [(1, 0, "a"), (2, 1, "")]


def test_messy_table(spark, labelled):
    weights = quality.fit(*labelled, "quality")
    docs = documents(spark).withColumnRenamed("d", "score")
    found = quality.score(docs, weights)
    assert found.columns == [name for name in docs.columns if name != "score"] + ["score", "predicted"]
    rows = found.collect()
    assert len(rows) == docs.count() and all(0 <= row.score <= 1 for row in rows)
    empty = {row.score for row in rows if not (row.text or "").split()}
    assert empty == {quality.sigmoid(weights[-1])}
    by_text = {}
    for row in rows:
        assert by_text.setdefault(row.text, row.score) == row.score
    assert LONG in by_text


def test_no_labels_and_no_rows(spark, labelled):
    docs, labels = labelled
    weights = quality.fit(docs, labels.limit(0), "quality")
    assert not weights.any()
    assert {(row.score, row.predicted) for row in quality.score(docs, weights).collect()} == {(0.5, 1)}
    assert quality.score(docs.limit(0), weights).collect() == []
    assert not quality.fit(docs.limit(0), labels, "quality").any()


def test_query(spark):
    rows = op11_ngram_quality(spark, SF).collect()
    docs = {row.doc_id: row.text for row in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {row.doc_id: row.quality for row in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sorted(row.doc_id for row in rows) == sorted(docs)
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in rows)
    held = [row for row in rows if row.held_out and row.doc_id in labels]
    assert held and np.mean([row.predicted == labels[row.doc_id] for row in held]) >= 0.9
