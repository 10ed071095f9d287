import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from messy import TEXTS, documents, words

from starfold.llm import pseudo
from starfold.llm.queries import op10_masked_likelihood


def test_words_and_rows():
    texts = [*TEXTS, "A a\x0bB\x0c b", "é x y"]
    bins, rows = pseudo.word_bins(pa.array(texts))
    want = [(row, word) for row, text in enumerate(texts) for word in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    assert rows.tolist() == [row for row, _ in want]
    by_word = {}
    for one, (_, word) in zip(bins.tolist(), want):
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
        assert by_word.setdefault(key, one) == one
    assert len(set(by_word.values())) > 0.95 * len(by_word)
    again = pseudo.word_bins(pa.array(["lead", *texts]).slice(1))
    assert (again[0] == bins).all() and (again[1] == rows).all()
    assert len(pseudo.word_bins(pa.array([None, "", " "], pa.string()))[0]) == 0


def test_words_and_slices_of_bounded_size(monkeypatch):
    texts = pa.array([*TEXTS, words(3, 500), "", None, words(4, 10)])
    whole = pseudo.word_bins(texts)
    monkeypatch.setattr(pseudo, "WORDS_AT_ONCE", 7)
    again = pseudo.word_bins(texts)
    assert (whole[0] == again[0]).all() and (whole[1] == again[1]).all()
    monkeypatch.setattr(pseudo, "BYTES_AT_ONCE", 50)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], ["i", "text"])
    parts = list(pseudo._slices([batch, batch.slice(0, 0)]))
    assert len(parts) > 5 and [i for part in parts for i in part.column(0).to_pylist()] == list(range(len(texts)))


def test_windows_end_with_the_text():
    ids, rows = np.array([5, 6, 7, 8]), np.array([0, 0, 2, 2])
    edge = pseudo.EDGE
    assert pseudo.windows(ids, rows).T.tolist() == [[edge, edge, 6, edge], [edge, 5, edge, edge], [edge, edge, 8, edge], [edge, 7, edge, edge]]


def batch(count, seed=0):
    draws = np.random.default_rng(seed)
    return draws.integers(0, pseudo.WORDS + 1, (len(pseudo.OFFSETS), count)), draws.integers(0, pseudo.WORDS, count)


def test_chances_sum_to_one():
    params = pseudo.fresh()
    around = np.repeat(batch(1)[0], pseudo.WORDS, axis=1)
    log_p = pseudo.forward(params, around, np.arange(pseudo.WORDS)).log_p
    assert np.exp(log_p).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_by_differences():
    params = [value.astype(np.float64) for value in pseudo.fresh()]
    around, ids = batch(50)
    found = pseudo.gradients(params, pseudo.forward(params, around, ids), ids)
    draws = np.random.default_rng(1)
    for number, value in enumerate(params):
        flat, gradient = value.reshape(-1), np.asarray(found[number]).reshape(-1)
        for at in {int(np.abs(gradient).argmax()), int(draws.integers(flat.size))}:
            kept = flat[at]
            sides = []
            for step in (1e-5, -1e-5):
                flat[at] = kept + step
                sides.append(-pseudo.forward(params, around, ids).log_p.mean())
            flat[at] = kept
            assert gradient[at] == pytest.approx((sides[0] - sides[1]) / 2e-5, rel=1e-2, abs=1e-6)


def test_prose_scores_above_the_same_words_shuffled(spark):
    draws = random.Random(1)
    frames = ["the cat sat on a mat", "we went to the old town", "she gave him a red book"]
    texts = [" ".join(draws.choice(frames) for _ in range(60)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    ids = pseudo.vocabulary(docs)
    params = pseudo.train(docs, ids, rounds=2)
    shuffled = [" ".join(draws.sample(text.split(), len(text.split()))) for text in texts[:50]]
    tests = [(i, text) for i, text in enumerate(texts[:50])] + [(100 + i, text) for i, text in enumerate(shuffled)]
    rows = {row["doc_id"]: row for row in pseudo.score(spark.createDataFrame(tests, "doc_id long, text string"), ids, params).collect()}
    assert all(rows[i]["mean_log_likelihood"] > rows[100 + i]["mean_log_likelihood"] + 0.5 for i in range(50))


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_scores(texts, wanted, params):
    """Word by word: symbols by counting, windows by index, chances by whole softmaxes, spellings by dictionaries."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", lowered(text or "")) for text in texts]
    counts = Counter(word for parts in split for word in parts)
    hashes = {word: int(pseudo.word_bins(pa.array([word]))[0][0]) for word in counts | Counter(lowered(" ".join(wanted)).split())}
    top = sorted(counts, key=lambda word: (-counts[word], hashes[word]))[: pseudo.FREQUENT]
    ids = {word: top.index(word) if word in top else pseudo.FREQUENT + (hashes[word] % 2**64 >> 54) for word in hashes}
    others = [word for word in counts if ids[word] >= pseudo.FREQUENT]
    grams = Counter()
    for word in others:
        stream = [0, 0, *(byte + 1 for byte in word.encode()), 0]
        for three in zip(stream, stream[1:], stream[2:]):
            grams[three] += counts[word]
    pairs, before, single = Counter(), Counter(), Counter()
    for (a, b, c), n in grams.items():
        pairs[b, c] += n
        before[a, b] += n
        single[c] += n
    after = Counter()
    for (b, _), n in pairs.items():
        after[b] += n
    all_bytes = sum(single.values())

    def spelling(word):
        stream, total = [0, 0, *(byte + 1 for byte in word.encode()), 0], 0.0
        for a, b, c in zip(stream, stream[1:], stream[2:]):
            none = (single[c] + 1) / (all_bytes + pseudo.LETTERS)
            one = (pairs[b, c] + pseudo.TRUST * none) / (after[b] + pseudo.TRUST)
            total += math.log((grams[a, b, c] + pseudo.TRUST * one) / (before[a, b] + pseudo.TRUST))
        return total

    vectors, hidden_bias, class_w, class_b, member_w, member_b = (value.astype(float) for value in params)
    scores = []
    for text in wanted:
        parts = [ids[word] for word in lowered(text).split()]
        total = 0.0
        for at, (word, one) in enumerate(zip(lowered(text).split(), parts)):
            hidden = hidden_bias.copy()
            for place, offset in enumerate(pseudo.OFFSETS):
                near = parts[at + offset] if 0 <= at + offset < len(parts) else pseudo.EDGE
                hidden += vectors[place * (pseudo.WORDS + 1) + near]
            hidden, (kind, member) = np.tanh(hidden), divmod(one, pseudo.MEMBERS)
            for logits, pick in ((hidden @ class_w + class_b, kind), (hidden @ member_w[kind] + member_b[kind], member)):
                total += logits[pick] - math.log(np.exp(logits).sum())
            if one >= pseudo.FREQUENT:
                mates = [counts[other] for other in others if ids[other] == one]
                freed = pseudo.DISCOUNT * max(len(mates), 1) / max(sum(mates), 1)
                spelled = min(0.0, spelling(word) + math.log(pseudo.BUCKETS))
                if counts[word]:
                    total += math.log((counts[word] - pseudo.DISCOUNT) / sum(mates) + freed * math.exp(spelled))
                else:
                    total += math.log(freed) + spelled
        scores.append(total)
    return scores


def many_words(count):
    """Texts of words of which only some are frequent."""
    draws = random.Random(6)
    known = [f"{a}{b}{c}{d}" for a in "bcdfg" for b in "aeiou" for c in "klmnr" for d in "aeiou"] + [f"w{i}x" for i in range(900)]
    return [" ".join(draws.choices(known, weights=range(len(known), 0, -1), k=80)) for _ in range(count)]


def test_scores_of_a_plain_scorer(spark):
    texts = [*many_words(40), "Bake bake é ÉÉ", None, "", "x" * 130]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    ids = pseudo.vocabulary(docs)
    params = pseudo.train(docs, ids, rounds=2)
    wanted = [texts[0], texts[40], "never seenbefore bake w899x w899x", "y" * 400, texts[43], ""]
    tests = spark.createDataFrame(list(enumerate(wanted)), "doc_id long, text string")
    rows = {row["doc_id"]: row for row in pseudo.score(tests, ids, params).collect()}
    for number, want in enumerate(plain_scores(texts, wanted, params)):
        assert rows[number]["log_likelihood"] == pytest.approx(want, rel=1e-4, abs=1e-6)
        assert rows[number]["n_words"] == len(wanted[number].split())


def test_counts_grow_with_the_corpus_and_tell_copies(spark):
    texts = many_words(60)
    texts += [texts[0], "qqrrz kkwwv zzpty", "qqrrz kkwwv zzpty", "qqrrt kkwwd zzptz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = pseudo.vocabulary(docs)
    assert ids.counts.count() == len({word for text in texts for word in text.split()}) > pseudo.FREQUENT == len(ids.hashes)
    assert ids.different.sum() == ids.counts.count() - pseudo.FREQUENT
    found = {row["doc_id"]: row["log_likelihood"] for row in pseudo.score(docs, ids, pseudo.fresh()).collect()}
    assert found[0] == pytest.approx(found[60]) and found[61] == pytest.approx(found[62])
    assert found[61] > found[63] + 2


def test_long_words_differ_by_place():
    one, other = ("a" * 64 + "b" * 64, "b" * 64 + "a" * 64)
    assert len(set(pseudo.word_bins(pa.array([one, other, one + " x"]))[0].tolist())) == 3


def test_vocabulary_is_counted_over_all(spark):
    docs = documents(spark, ["b b b a a c"] * 5)
    ids = pseudo.vocabulary(docs)
    bins = {word: pseudo.word_bins(pa.array([word]))[0][0] for word in "abc"}
    assert [ids[bins[word]] for word in "bac"] == [0, 1, 2]


def test_messy_and_empty_tables(spark):
    docs = documents(spark).withColumnRenamed("h", "n_words")
    ids = pseudo.vocabulary(docs)
    rows = pseudo.score(docs, ids, pseudo.train(docs, ids)).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert (row["mean_log_likelihood"] is None) == (row["n_words"] == 0)
        assert row["log_likelihood"] <= 0 and np.isfinite(row["log_likelihood"])
    empty = documents(spark, [])
    ids = pseudo.vocabulary(empty)
    assert pseudo.score(empty, ids, pseudo.train(empty, ids)).count() == 0


def test_query(spark):
    rows = op10_masked_likelihood(spark, "/root/testdata/sf0.001").collect()
    assert len({row["doc_id"] for row in rows}) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert all(row["log_likelihood"] < 0 for row in rows)
