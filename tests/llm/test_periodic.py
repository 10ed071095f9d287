import random
from itertools import compress

import numpy as np
import pytest
from messy import documents
from pyspark.sql import functions as F

from starfold.llm import periodic
from starfold.llm.queries import planted


def brute(words):
    """Every stretch of every period, word by word; of equal stretches the least period."""
    n, found = len(words), {}
    for period in range(1, n // periodic.PERIODS + 1):
        i = 0
        while i + period < n:
            if words[i] != words[i + period]:
                i += 1
                continue
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            length = i + period - start
            if length >= max(periodic.LEAST, periodic.PERIODS * period):
                found.setdefault((start, length), period)
    return sorted(((s, n_words, p) for (s, n_words), p in found.items()), key=lambda run: (run[0], run[2]))


def kept(words, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [word for i, word in enumerate(words) if i not in dropped]


def text_of(draws):
    """Words with periods in periods, runs that touch and overlap, and noise."""
    n, letters, words = draws.choice([0, 5, 24, 60, 120, 300]), draws.choice([1, 2, 2, 3, 20]), []
    while len(words) < n:
        if draws.random() < 0.7:
            base = [draws.randrange(letters) for _ in range(draws.choice([1, 2, 3, 5, 8, 9, 13, 17, 30]))]
            if draws.random() < 0.5:
                base = base * draws.randint(1, 3) + [draws.randrange(letters)]
            words += base * draws.randint(1, 6)
        else:
            words.append(draws.randrange(letters))
    return [b"%d" % word for word in words[:n]]


@pytest.mark.parametrize("seed", range(8))
def test_runs_are_those_of_a_plain_search(seed):
    draws = random.Random(seed)
    for _ in range(60):
        texts = [text_of(draws) for _ in range(draws.choice([1, 1, 3, 6]))]
        for words, found in zip(texts, periodic.searched(texts), strict=True):
            runs = [tuple(run) for run in found.tolist()]
            assert runs == brute(words)
            assert periodic.collapsed(words, found) == b" ".join(kept(words, runs))


@pytest.mark.parametrize(
    "words, runs",
    [
        (b"a " * 23, []),
        (b"a " * 24, [(0, 24, 1)]),
        (b"a b c d e f g h i " * 2 + b"a b c d e f g h", []),
        (b"x " + b"a b c d e f g h i " * 3 + b"y", [(1, 27, 9)]),
        (b"a a b " * 8, [(0, 24, 3)]),
        (b"a " * 30 + b"b " * 30, [(0, 30, 1), (30, 30, 1)]),
        (b"a b " * 12 + b"a c " * 12, [(0, 25, 2), (24, 24, 2)]),
        ((b"a " * 24 + b"b ") * 3, [(0, 24, 1), (0, 75, 25), (25, 24, 1), (50, 24, 1)]),
    ],
)
def test_known_runs(words, runs):
    assert [tuple(run) for run in periodic.searched([words.split()])[0].tolist()] == runs


def test_documents_never_meet():
    apart = periodic.searched([[b"a"] * 12, [b"a"] * 12, [], [b"a"] * 24])
    assert [len(found) for found in apart] == [0, 0, 0, 1]


def test_ranks_and_array_are_those_of_sorted_suffixes():
    draws = random.Random(5)
    keys = np.array([draws.randrange(3) for _ in range(200)])
    levels, order = periodic.refined(keys)
    suffixes = [tuple(keys[i:]) for i in range(len(keys))]
    assert order.tolist() == sorted(range(len(keys)), key=lambda i: suffixes[i])
    for level, ranks in enumerate(levels):
        begins = [suffix[: 1 << level] for suffix in suffixes]
        assert ranks.tolist() == [sum(other < own for other in begins) for own in begins]


def test_order_statistics():
    draws = np.random.default_rng(2)
    values = draws.permutation(300)
    tree = periodic.Wavelets(values, 300)
    low, high = np.sort(draws.integers(0, 301, (2, 500)), axis=0)
    than = draws.integers(0, 301, 500)
    assert tree.less(low, high, than).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, than)]
    some = high > low
    place = draws.integers(0, np.maximum(high - low, 1))[some]
    want = [int(np.sort(values[a:b])[c]) for a, b, c in zip(low[some], high[some], place)]
    assert tree.smallest(low[some], high[some], place).tolist() == want


@pytest.mark.parametrize("words", [[b"a"] * 50_000, [b"%d" % (i % 9001) for i in range(40_000)], [b"%d" % i for i in range(50_000)]])
def test_long_texts(words):
    found = periodic.searched([words])[0].tolist()
    assert found == ([] if len(set(words)) == len(words) else [[0, len(words), len(set(words))]])


def test_messy_table(spark, monkeypatch):
    monkeypatch.setattr(periodic, "WORDS_AT_ONCE", 40)
    docs = documents(spark).withColumn("runs", F.lit("taken")).withColumn("start", F.lit(7))
    more = docs.limit(1).withColumn("text", F.lit("x " + "é b\n" * 40)).withColumn("doc_id", F.lit(99).cast("long"))
    found = periodic.find_runs(docs.unionByName(more).unionByName(more))
    assert found.columns == [n for n in docs.columns if n not in ("text", "runs")] + ["n_words", "runs", "collapsed"]
    rows = found.collect()
    assert len(rows) == docs.count() + 2
    texts = {row.doc_id: row.text for row in docs.collect()} | {99: "x " + "é b\n" * 40}
    for row in rows:
        words = (texts[row.doc_id] or "").encode().split()
        runs = [tuple(run) for run in row.runs]
        assert row.n_words == len(words) and runs == brute(words)
        assert row.collapsed == b" ".join(kept(words, runs)).decode()
    assert [row.runs for row in rows if row.doc_id == 99] == [[(1, 80, 2)]] * 2
    assert periodic.find_runs(docs.limit(0)).collect() == []


def test_most_repeated(spark):
    rows = [
        (0, []), (1, [(0, 30, 3), (50, 40, 4)]), (2, [(0, 30, 4), (9, 24, 1), (9, 48, 2)])
    ]
    frame = spark.createDataFrame(rows, "id long, runs array<struct<start: long, length: long, period: long>>")
    found = frame.select("id", periodic.most_repeated(F.col("runs")).alias("best")).collect()
    assert {row.id: row.best and tuple(row.best) for row in found} == {0: None, 1: (0, 30, 3), 2: (9, 24, 1)}


def test_planted_periods(spark):
    text = " ".join(f"w{i}" for i in range(200))
    ids = list(range(300)) + [None]
    frame = spark.createDataFrame([(i, text) for i in ids] + [(10**6 + i, None) for i in range(20)] + [(10**7 + i, " \n") for i in range(20)], "id long, text string")
    import zlib

    for row in frame.select("id", "text", planted(F.col("text"), F.col("id")).alias("new")).collect():
        h = zlib.crc32(str(row.id).encode())
        words = (row.text or "").split()
        if row.id is None or h % 10 or not words:
            assert row.new == row.text
            continue
        a = h // 10 % len(words)
        p = 1 + (len(words) - a) // (3 + h // 10 % 8)
        assert row.new.split() == [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        assert list(compress(words, [i < a for i in range(len(words))])) == row.new.split()[:a]
