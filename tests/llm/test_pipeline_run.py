"""The pipeline against a plain version of each stage."""

import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from messy import TEXTS, words

import corpus_pipeline
from starfold.llm import bpe
from test_mixing import expected_targets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
OTHER = ["der", "und", "schlug", "über", "zwölf", "straße", "nicht"]


def corpus():
    """Two languages, texts without letters, copies, near copies, and passages that documents share."""
    draws = random.Random(5)
    german = lambda count: " ".join(draws.choice(OTHER) + draws.choice(OTHER) for _ in range(count))
    texts = [(words(i, 120), "xx") for i in range(40)] + [(german(120), "de") for _ in range(20)]
    passage = words(77, 70)
    texts += [(words(200 + i, 60) + " " + passage + " " + words(300 + i, 60), "xx") for i in range(6)]
    texts += [(texts[3][0], "xx")] * 4 + [(texts[5][0].replace(" ", "  ", 1), "xx"), (texts[6][0] + " end", "xx")]
    texts += [("12 34 --", "xx"), ("", "de"), (None, None), (" \n", None)]
    texts += [(german(40), None), (words(400, 9000), "xx")]
    sources = ["a", "b", "b", "c", None]
    return [(i, text, lang, sources[i % 5], None if text is None else len(text)) for i, (text, lang) in enumerate(texts)]


def plain_languages(rows):
    return [row for row in rows if row[1] and any(c.isalpha() for c in row[1])]


def shingles(text):
    found = text.lower().split()
    return {" ".join(found[i : i + 5]) for i in range(max(1, len(found) - 4))}


def plain_copies(rows):
    kept = []
    for row in rows:
        own = shingles(row[1])
        if not any(len(own & other) >= 0.8 * len(own | other) for _, other in kept):
            kept.append((row, own))
    return [row for row, _ in kept]


def plain_repeats(rows, length=200):
    data = [row[1].encode() for row in rows]
    counts = Counter(one[i : i + length] for one in data for i in range(len(one) - length + 1))
    out = []
    for row, one in zip(rows, data):
        gone = bytearray(len(one))
        for i in range(len(one) - length + 1):
            if counts[one[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        text = bytes(byte for byte, dead in zip(one, gone) if not dead).decode("utf-8", "ignore")
        out.append((row[0], text, *row[2:4], len(text)))
    return out


def sizes(rows):
    totals = defaultdict(int)
    for row in rows:
        totals[row[3]] += len(row[1].split())
    return totals


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    results = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, ""), "test-stage")
        results.append(docs)
    return results


def rows_of(df):
    return sorted((tuple(row[name] for name in COLUMNS) for row in df.collect()), key=lambda row: (row[0], row[1]))


def test_stage_names_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_languages(stages):
    assert rows_of(stages[0]) == plain_languages(corpus())


def test_copies(stages):
    assert rows_of(stages[1]) == plain_copies(rows_of(stages[0]))
    assert len(rows_of(stages[1])) == len(rows_of(stages[0])) - 6


def test_repeats(stages):
    assert rows_of(stages[2]) == plain_repeats(rows_of(stages[1]))
    assert rows_of(stages[2]) != rows_of(stages[1])


def test_mix(stages):
    before = {row[0]: row for row in rows_of(stages[2])}
    totals = sizes(before.values())
    targets = expected_targets(totals)
    mixed = rows_of(stages[3])
    for source, total in sizes(mixed).items():
        assert abs(total - float(targets[source])) <= 1
    cuts = defaultdict(set)
    for row in mixed:
        whole = before[row[0]]
        assert row[2:4] == whole[2:4] and row[4] == len(row[1])
        assert whole[1].startswith(row[1])
        if row[1] != whole[1]:
            cuts[row[3]].add(row[0])
            assert row[1].split() == whole[1].split()[: len(row[1].split())]
    assert all(len(ids) == 1 for ids in cuts.values())
    epochs = Counter(row[0] for row in mixed)
    assert max(epochs.values()) <= 3


def test_tokens(stages):
    encoder = bpe.encoding(public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN)
    rows = stages[4].collect()
    assert rows_of(stages[4]) == rows_of(stages[3])
    for row in rows:
        assert list(row["ids"]) == encoder.encode_ordinary(row["text"]) and row["n_tokens"] == len(row["ids"])
        assert encoder.decode(row["ids"]) == row["text"]


def test_run_is_the_stages(spark, stages, tmp_path):
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(corpus_pipeline.run(spark, str(tmp_path))) == rows_of(stages[4])


def test_messy_and_empty_tables(spark, tmp_path):
    messy = [(i, text, None if i % 3 else "en", None, 1) for i, text in enumerate([*TEXTS, *TEXTS])] + [(None, "no id", "en", "s", 2)] * 2
    for name, rows in (("messy", messy), ("empty", [])):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(found) == (name == "messy")
        given = {(row[0], *row[2:4]): re.sub(r"\s", "", row[1] or "") for row in rows}
        for row in found:
            # What is left of a text is some of its characters in order, and its tokens are those of what is left.
            letters = iter(given[row.doc_id, row.lang, row.source])
            assert all(letter in letters for letter in re.sub(r"\s", "", row.text))
            assert row.n_tokens == len(row.ids) and row.n_chars == len(row.text)


def taken_words(spark, rows, schema):
    found = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, schema).repartition(3), "")
    words = defaultdict(int)
    for row in found.collect():
        words[row["source"]] += len((row["text"] or "").split())
    return dict(words), found


def test_mix_of_repeated_rows(spark):
    """Eight equal rows of one source and thirty of another: budgets are met to the word, as by the sizes alone."""
    text = "one two three four five six seven eight nine ten"
    for rows in (
        [(1, text, "en", "a", 9)] * 8 + [(2, text, "en", "b", 9)] * 30,
        [(1, text, "en", "a", 9)] + [(1, text, "en", "b", 9)] * 9,
        [(1, text, "en", "a", 9), (1, text + " x", "en", "a", 9), (1, text, "de", "a", 9), (1, None, None, None, None)],
    ):
        sizes = spark.createDataFrame([(row[0], row[3], len((row[1] or "").split())) for row in rows], "doc_id long, source string, size long")
        budget = {row.source: int(row.target) for row in corpus_pipeline.mixing.source_targets(sizes).collect() if int(row.target)}
        found, _ = taken_words(spark, rows, SCHEMA)
        assert found == budget


def test_columns_named_as_the_mix_names_them(spark):
    rows = [(i, "w " * (i + 1), "en", "ab"[i % 2], 2, i, f"t{i}", -i) for i in range(9)]
    words, found = taken_words(spark, rows, SCHEMA + ", size int, taken string, target int")
    assert found.columns == COLUMNS + ["size", "taken", "target"] and sum(words.values()) > 0
    assert all((row["size"], row["taken"], row["target"]) == (row["doc_id"], f"t{row['doc_id']}", -row["doc_id"]) for row in found.collect())


def test_columns_named_as_the_language_model_names_them(spark):
    rows = [(*row, "own", 5) for row in corpus()]
    docs = spark.createDataFrame(rows, SCHEMA + ", lang_pred string, score int")
    found = corpus_pipeline.identify_language(spark, docs, "")
    assert found.columns == docs.columns and {(row.lang_pred, row.score) for row in found.collect()} == {("own", 5)}
