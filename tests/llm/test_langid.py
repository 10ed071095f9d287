import math
import random
import string
import zlib

import numpy as np
import pytest
from messy import documents
from pyspark.sql import functions as F

from starfold.llm import langid
from starfold.llm.queries import op4_output_code_language

SYLLABLES = {
    "aa": "ka lo mi pe tu", "bb": "sch ung ein der hei", "cc": "ción que los par ado", "dd": "ingly the and tion of",
    "ee": "ého že při ost ní", "ff": "ский на что ого при", "gg": "ään yys kka isto in", "hh": "ların ve bir dır çok",
}


def prose(language, seed, count=30):
    draws = random.Random(f"{language}{seed}")
    parts = SYLLABLES[language].split()
    return " ".join("".join(draws.choices(parts, k=draws.randint(1, 3))) for _ in range(count))


def labelled(spark, languages, count=20):
    rows = [(i, prose(name, i), name) for i in range(count) for name in languages]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("count", [1, 2, 3, 4, 6, 7, 40])
def test_codewords_differ(count):
    code = langid.codewords(count)
    assert len(code) == count and len({tuple(row) for row in code}) == count
    assert all(len(set(column)) == 2 for column in code.T)
    apart = min((np.sum(code[i] != code[j]) for i in range(count) for j in range(i)), default=9)
    assert apart >= (1 if count < 3 else 2 ** (count - 2) if count <= 6 else 3)


@pytest.mark.parametrize("count", [1, 2, 4, 8])
def test_held_out_texts(spark, count):
    names = list(SYLLABLES)[:count]
    model = langid.fit(labelled(spark, names))
    assert model.languages == names
    for name in names:
        for seed in range(100, 110):
            language, score, ambiguous = model.decode(prose(name, seed))
            assert language == name and 0.6 < score <= 1 and not ambiguous


def test_a_wrong_bit_is_corrected(spark):
    names = list(SYLLABLES)[:4]
    model = langid.fit(labelled(spark, names))
    for bit in range(model.code.shape[1]):
        turned = model.weights.copy()
        turned[:, bit] *= -1
        weakened = langid.Model(model.languages, model.code, turned)
        assert sum(weakened.decode(prose(name, 7))[0] == name for name in names) == 4


def test_a_text_between_two_is_ambiguous(spark):
    model = langid.fit(labelled(spark, ["aa", "bb"]))
    assert model.decode("zzz")[2]


def plain_grams(text):
    """Bins of a text's n-grams, one n-gram at a time."""
    blank = str.maketrans(dict.fromkeys(string.punctuation + string.digits, " "))
    data = b" " + b" ".join(text.lower().translate(blank).encode().split()) + b" "
    for n in (2, 3, 4):
        for at in range(len(data) - n + 1):
            mixed = n
            for byte in data[at : at + n]:
                mixed = (mixed ^ byte) * 0x9E3779B1 % 2**32
            yield mixed >> 16


def plain_model(labelled_texts, code, names):
    """The weight of each bit and bin that any of the texts has, and of all other bins."""
    counts = {name: {} for name in names}
    for text, name in labelled_texts:
        for one in plain_grams(text):
            counts[name][one] = counts[name].get(one, 0) + 1
    shares = {}
    for name in names:
        total = sum(counts[name].values())
        extra = langid.SMOOTHING * total / langid.BINS
        shares[name] = lambda one, own=counts[name], extra=extra, total=total: (own.get(one, 0) + extra) / (total + extra * langid.BINS)

    def weight(bit, one):
        sides = {side: [shares[name](one) for name, row in zip(names, code) if row[bit] == side] for side in (1, -1)}
        return math.log((sum(sides[1]) / len(sides[1])) / (sum(sides[-1]) / len(sides[-1])))

    return weight


def plain_decode(text, code, names, weight):
    grams = list(plain_grams(text))
    margins = [langid.SHARPNESS * sum(weight(bit, one) for one in grams) / max(1, len(grams)) for bit in range(len(code[0]))]
    losses = [sum(math.log1p(math.exp(-int(sign) * margin)) for sign, margin in zip(row, margins)) for row in code]
    chances = [math.exp(min(losses) - loss) for loss in losses]
    best = next(name for name, loss in zip(names, losses) if loss - min(losses) < langid.SAME_LOSS)
    return best, max(chances) / sum(chances)


def test_predictions_are_those_of_a_plain_decoder(spark):
    names = list(SYLLABLES)[:4]
    docs = labelled(spark, names, 6)
    model = langid.fit(docs)
    weight = plain_model([(row["text"], row["lang"]) for row in docs.collect()], model.code, names)
    texts = [prose(name, seed) for name in names for seed in (50, 51)]
    texts += [prose("aa", 60) + " " + prose("bb", 60), "Zzz, 12!", "É", "a.b;c"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in langid.identify(asked, model).collect():
        best, score = plain_decode(texts[row["doc_id"]], model.code, names, weight)
        assert (row["lang_pred"], row["ambiguous"]) == (best, score < langid.CLEAR_SCORE)
        assert row["score"] == pytest.approx(score, abs=1e-4)


def test_counts_are_of_every_text(spark):
    docs = labelled(spark, ["aa", "bb"], 5)
    counts = {(row["language"], row["bin"]): row["n"] for row in langid.count_ngrams(docs, "text", "lang").collect()}
    want = {}
    for row in docs.collect():
        for some in langid.bins(langid.letters(row["text"])):
            for one in some.tolist():
                want[row["lang"], one] = want.get((row["lang"], one), 0) + 1
    assert counts == want


def test_long_texts_in_stretches(monkeypatch):
    data = langid.letters(prose("bb", 1, 500))
    whole = np.sort(np.concatenate(list(langid.bins(data))))
    monkeypatch.setattr(langid, "BYTES_AT_ONCE", 64)
    assert (np.sort(np.concatenate(list(langid.bins(data)))) == whole).all()


def test_messy_table(spark):
    docs = documents(spark).withColumnRenamed("fingerprint", "score")
    found = langid.identify(docs, langid.fit(docs))
    assert found.columns == [name for name in docs.columns if name != "score"] + ["lang_pred", "score", "ambiguous"]
    rows = found.collect()
    assert len(rows) == docs.count()
    for row in rows:
        lettered = any(c.isalpha() for c in row["text"] or "")
        assert row["lang_pred"] in (("en", "fr", "de") if lettered else ("und",))
        assert 0 <= row["score"] <= 1
    empty = documents(spark, [])
    assert langid.identify(empty, langid.fit(empty)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {row["lang_pred"] for row in langid.identify(unlabelled, langid.fit(unlabelled)).collect()} == {"und"}


def test_query(spark):
    rows = op4_output_code_language(spark, "/root/testdata/sf0.01").collect()
    docs = {row["doc_id"]: row["lang"] for row in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(row["doc_id"] for row in rows) == sorted(docs)
    held = [row for row in rows if row["held_out"]]
    assert {row["doc_id"] for row in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([row["lang_pred"] == docs[row["doc_id"]] for row in held]) > 0.99
