import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import TEXTS, documents, words
from pyspark.sql import functions as F

from starfold.llm import repeats
from starfold.llm.queries import op1_suffix_array_dedup
from starfold.llm.suffixes import suffix_array


def brute(texts, length=200):
    """Removed bytes of each text, by counting every string."""
    data = [(text or "").encode() for text in texts]
    counts = Counter(one[i : i + length] for one in data for i in range(len(one) - length + 1))
    out = []
    for one in data:
        gone = bytearray(len(one))
        for i in range(len(one) - length + 1):
            if counts[one[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(byte for byte, dead in zip(one, gone) if not dead)
        runs = sum(1 for i, dead in enumerate(gone) if dead and not (i and gone[i - 1]))
        out.append((len(one), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def found(docs, **options):
    rows = repeats.without_repeats(docs, repeats.DIGESTS, repeats.digests, **options).collect()
    return sorted((row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]) for row in rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(symbols):
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@pytest.mark.parametrize("period", [1, 2, 7, 50])
def test_suffix_array_of_repeats(period):
    symbols = [random.Random(period).randint(0, 2) for _ in range(period)] * (400 // period)
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def corpus():
    """Copies, shared passages with other neighbours, edits, repeats within a text, and periods."""
    passage, other = words(1, 60), words(2, 80)
    texts = [words(10 + i, 40) + passage + words(50 + i, 40) for i in range(12)]
    texts += [other[: 150 + i] + words(90 + i, 30) + other[150 + i :] for i in range(8)]
    texts += [words(3, 90)] * 3 + [words(4, 50) * 2, "ab" * 400, "ab" * 90, "é" * 150, words(5, 300)]
    texts += [passage[:199], passage[:200], passage[7:206] + "\x00", "🙂" * 51 + passage]
    return texts + TEXTS


@pytest.mark.parametrize("block_contexts", [1, 3, 4096])
def test_against_brute_force(spark, block_contexts):
    texts = corpus()
    docs = documents(spark, texts).repartition(5)
    want = sorted(brute([row["text"] for row in docs.collect()]))
    assert found(docs, block_contexts=block_contexts) == want
    assert any(removed not in (0, size) for size, removed, _, _ in want)


def test_short_strings(spark):
    docs = documents(spark, [words(i % 5, 12) + words(i, 4) for i in range(30)])
    assert found(docs, length=20) == sorted(brute([row["text"] for row in docs.collect()], 20))


def test_stretches_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "STARTS_AT_ONCE", 300)
    texts = [words(1, 500), words(2, 300) + words(1, 200), words(3, 40)]
    import numpy as np

    data = "".join(texts).encode()
    ends = np.cumsum([0, *(len(text.encode()) for text in texts)])
    covered = Counter()
    for hashes, at, a, b, _ in repeats.anchors_of(np.frombuffer(data, np.uint8), ends):
        for place, first, last in zip(at.tolist(), a.tolist(), b.tolist()):
            covered.update(range(first, last + 1))
            assert all(start <= place and place + 100 <= start + 200 for start in (first, last))
    want = {start for low, high in zip(ends, ends[1:]) for start in range(low, high - 199)}
    assert set(covered) == want and set(covered.values()) == {1}


def test_texts_and_other_columns_stay(spark):
    docs = documents(spark, corpus())
    left = repeats.remove_repeats(docs)
    assert left.columns == docs.columns
    assert left.drop("text").exceptAll(docs.drop("text")).count() == 0 and left.count() == docs.count()
    assert left.filter("text is null").count() == 0
    lone = left.filter(F.col("text").contains(words(5, 300)[:400])).count()
    assert lone == 1


def test_empty_table(spark):
    assert found(documents(spark, [])) == []


def test_query(spark):
    rows = op1_suffix_array_dedup(spark, "/root/testdata/sf0.001").collect()
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    want = dict(zip(sorted(texts), brute([texts[i] for i in sorted(texts)])))
    assert {row["doc_id"]: (row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]) for row in rows} == want
