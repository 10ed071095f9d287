import random
import re

import numpy as np
import pytest
import xxhash
from messy import TEXTS, documents, words
from pyspark.sql import functions as F

from starfold.llm import simhash
from starfold.llm.graph import components
from starfold.llm.queries import op5_simhash_components


def brute_print(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    parts = [" ".join(found[i : i + shingle]) for i in range(len(found) - shingle + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(part.encode(), 42) for part in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints, apart=2):
    """Least reachable key of each (key, fingerprint)."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= apart:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        known = [k for k in (least.get(find(i)), key) if k is not None]
        least[find(i)] = min(known, default=None)
    return [least[find(i)] for i in range(len(prints))]


def test_fingerprints():
    texts = [*TEXTS, "A B C", "a b", "Éa\x0bb\x0cc\x1cd e", words(1, 400)]
    assert [simhash.fingerprint(text) for text in texts] == [brute_print(text) for text in texts]


def test_long_texts_in_stretches(monkeypatch):
    text = words(7, 1000)
    whole = simhash.fingerprint(text), simhash.wide_fingerprint(text)
    for size in (1, 17, 100):
        monkeypatch.setattr(simhash, "STRETCH_BYTES", size)
        assert (simhash.fingerprint(text), simhash.wide_fingerprint(text)) == whole
        assert [simhash.fingerprint(one) for one in TEXTS] == [brute_print(one) for one in TEXTS]


@pytest.mark.parametrize("crowded", [2, 4096])
def test_links_connect_what_is_near(spark, crowded):
    draws = random.Random(3)
    values = [0, 1, 3, 7, 15, (1 << 64) - 1]
    for _ in range(60):
        value = draws.getrandbits(64)
        for _ in range(4):
            values.append(value)
            for bit in draws.sample(range(64), draws.randint(1, 3)):
                value ^= 1 << bit
    values = sorted(set(values))
    signed = [int(np.uint64(value).astype(np.int64)) for value in values]
    frame = spark.createDataFrame([(value,) for value in signed], "fingerprint long")
    roots = {row["node"]: row["root"] for row in components(simhash.linked_fingerprints(frame, crowded=crowded)).collect()}
    want = brute_components([(one, value) for one, value in zip(signed, values)])
    assert [roots.get(one, one) for one in signed] == want


def test_links_stop_at_two_bits(spark):
    with pytest.raises(ValueError):
        simhash.linked_fingerprints(spark.createDataFrame([], "fingerprint long"), apart=3)


def test_query(spark):
    rows = op5_simhash_components(spark, "/root/testdata/sf0.001").collect()
    docs = {row["doc_id"]: row["text"] for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    prints = [(i, brute_print(docs[i])) for i in sorted(docs)]
    want = {i: (f"{value:016x}", least) for (i, value), least in zip(prints, brute_components(prints))}
    assert {row["doc_id"]: (row["fingerprint"], row["component_id"]) for row in rows} == want


def test_messy_table(spark):
    docs = documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    prints = [(row["doc_id"], brute_print(row["text"])) for row in docs.collect()]
    want = [(key, least) for (key, _), least in zip(prints, brute_components(prints))]
    assert sorted(((row["doc_id"], row["component_id"]) for row in rows), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (1, 0)]
    found = {row["node"]: row["root"] for row in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def edited(text, share, seed):
    draws = random.Random(seed)
    parts = text.split()
    for at in draws.sample(range(len(parts)), round(share * len(parts))):
        parts[at] = f"edit{seed}x{at}"
    return " ".join(parts)


def test_near_copies_leave_one(spark):
    bases = [words(100 + i, 300) for i in range(30)]
    texts = [(1000 + i, base) for i, base in enumerate(bases)]
    # A hundredth of the words replaced: shingle sets are about 0.9 alike; a tenth: far below 0.8.
    texts += [(10 + i, edited(base, 0.01, i)) for i, base in enumerate(bases[:20])]
    texts += [(2000 + i, edited(base, 0.1, i)) for i, base in enumerate(bases[20:])]
    texts += [(3000, bases[0]), (3000, bases[0]), (5, None), (6, ""), (None, "alone"), (None, "alone")]
    docs = spark.createDataFrame([(i, text, "x") for i, text in texts], "doc_id long, text string, fingerprint string")
    left = simhash.near_copies(docs)
    assert left.columns == docs.columns
    ids = sorted((row["doc_id"] for row in left.collect()), key=str)
    want = [*range(10, 30), *range(1020, 1030), *range(2000, 2010), 5, None]
    assert ids == sorted(want, key=str)


def test_near_copies_of_a_crowd(spark, monkeypatch):
    base = words(9, 300)
    docs = spark.createDataFrame([(i, edited(base, 0.01, i)) for i in range(300)], "doc_id long, text string")
    assert [row["doc_id"] for row in simhash.near_copies(docs).collect()] == [0]
    assert simhash.near_copies(docs.limit(0)).count() == 0
    assert simhash.near_copies(docs.filter(F.col("doc_id") < 3).unionByName(docs.filter(F.col("doc_id") < 3))).count() == 1


def test_crowded_keys_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_AT_ONCE", 50)
    # One key, so that no other can make up for a lost link.
    choices = simhash.wide_blocks(1000, 0.8)[:1]
    free = [bit for bit in range(simhash.WIDE_BITS) if bit not in set(choices[0].tolist())]
    draws = random.Random(8)
    values = set()
    for _ in range(60):
        value = sum(1 << bit for bit in free if draws.random() < 0.5)
        for _ in range(6):
            values.add(value)
            for bit in draws.sample(free, 30):
                value ^= 1 << bit
    values = sorted(values)
    frame = spark.createDataFrame([(value.to_bytes(32, "little"),) for value in values], "fingerprint binary")
    roots = {bytes(row["node"]): bytes(row["root"]) for row in components(simhash.wide_links(frame, choices, 39)).collect()}
    found = [roots.get(one, one) for one in (value.to_bytes(32, "little") for value in values)]
    want = brute_components([(value.to_bytes(32, "little"), value) for value in values], 39)
    assert found == want and len(set(want)) == 60


def test_blocks_grow_with_the_corpus():
    before = 0
    for count in (0, 1, 10**6, 10**7, 10**9, 10**11):
        blocks, width = simhash.wide_blocks(count, 0.8).shape
        assert count / 2**width <= simhash.UNRELATED_AT_A_KEY
        assert 1 - (1 - (1 - simhash._differing(0.8)) ** width) ** blocks >= 0.95
        assert blocks >= before and blocks << width < 1 << 63
        before = blocks
    # Far slower than the corpus.
    assert len(simhash.wide_blocks(10**9, 0.8)) < 10 * len(simhash.wide_blocks(10**6, 0.8))


def replaced(text, count, seed):
    """``count`` words, at least five apart, replaced: each takes five shingles out of both sets."""
    parts = text.split()
    for number in range(count):
        parts[10 + 30 * number] = f"other{seed}x{number}"
    return " ".join(parts)


def test_copies_are_those_of_the_stated_similarity(spark):
    rows, alike = [], {}
    for count in (5, 6, 7, 8):
        for number in range(60):
            base, at = words(1000 * count + number, 300), 10_000 * count + 2 * number
            rows += [(at, base), (at + 1, replaced(base, count, at))]
            one, other = (set(simhash.shingle_set(text).tolist()) for _, text in rows[-2:])
            alike[at + 1] = len(one & other) / len(one | other)
    kept = {row["doc_id"] for row in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(at in kept for at, _ in rows if at % 2 == 0)
    assert all(at in kept for at, share in alike.items() if share < 0.8)
    close = [at for at, share in alike.items() if share >= 0.8]
    assert len(close) >= 100 and sum(at not in kept for at in close) >= 0.9 * len(close)


def test_near_copies_keep_what_plain_comparison_keeps(spark, monkeypatch):
    # Groups of copies of copies, some crowding their keys; similarities stay clear of the limit.
    monkeypatch.setattr(simhash, "BUCKET_AT_ONCE", 20)
    texts = []
    for group in range(6):
        base = words(40_000 + group, 200)
        texts += [base, base] + [edited(base, 0.005, 100 * group + number) for number in range(12)]
        texts += [edited(base, 0.1, 100 * group + number) for number in range(50, 55)]
    sets = [set(simhash.shingle_set(text).tolist()) for text in texts]
    alike = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(texts)) for j in range(i)}
    assert not any(0.7 < share < 0.85 for share in alike.values())
    root = list(range(len(texts)))
    for (i, j), share in sorted(alike.items()):
        if share >= 0.8:
            old, new = max(root[i], root[j]), min(root[i], root[j])
            root = [new if one == old else one for one in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(row["doc_id"] for row in simhash.near_copies(docs).collect()) == sorted(set(root))


def test_least_forest_connects_at_every_limit():
    draws = np.random.default_rng(2)
    values = draws.integers(0, 1 << 12, 60).astype(np.uint64)
    edges = simhash.least_forest(values, 4)
    for limit in range(5):
        prints = [(i, int(value)) for i, value in enumerate(values)]
        roots = list(range(len(values)))
        for a, b in edges:
            if (int(values[a]) ^ int(values[b])).bit_count() <= limit:
                old, new = max(roots[a], roots[b]), min(roots[a], roots[b])
                roots = [new if root == old else root for root in roots]
        assert roots == brute_components(prints, limit)
