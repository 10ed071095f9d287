import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from messy import documents, words
from pyspark.sql import functions as F

from starfold.llm.mixing import first_words, mix, word_count


def expected_targets(totals, cap=3):
    order = sorted((s for s in totals if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in totals else [])
    weights = {source: place % 3 + 1 for place, source in enumerate(order)}
    words_left, open_, targets = Fraction(sum(totals.values())), set(order), {}
    while open_:
        share = words_left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * share > cap * totals[s]}
        if not full:
            targets |= {s: weights[s] * share for s in open_}
            break
        targets |= {s: Fraction(cap * totals[s]) for s in full}
        words_left -= sum(cap * totals[s] for s in full)
        open_ -= full
    return targets


def sized(docs):
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def check(spark, docs):
    rows = mix(sized(docs)).collect()
    texts = docs.collect()
    assert len(rows) == len(texts)
    assert sorted(row["size"] for row in rows) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", row["text"] or "")) for row in texts)
    totals, taken = defaultdict(int), defaultdict(int)
    for row in rows:
        totals[row["source"]] += row["size"]
        taken[row["source"]] += row["taken"]
        assert 0 <= row["taken"] <= 3 * row["size"]
    targets = expected_targets(totals)
    for row in rows:
        assert row["source_size"] == totals[row["source"]]
        assert row["target"] == pytest.approx(float(targets[row["source"]]), rel=1e-12, abs=1e-9)
    for source, words_taken in taken.items():
        assert abs(words_taken - float(targets[source])) <= 1
    return rows


def test_messy_table(spark):
    check(spark, documents(spark))


def test_small_sources_stop_at_three_epochs(spark):
    docs = documents(spark, [words(i, 300 if i % 13 in (0, 3) else 2 + i) for i in range(60)])
    rows = check(spark, docs)
    assert any(row["taken"] == 3 * row["size"] > 0 for row in rows)


def test_the_cut_is_in_key_order(spark):
    docs = spark.createDataFrame([(i, "s" if i < 90 else "t", 10 + i) for i in range(100)], "doc_id long, source string, size long")
    rows = {row["doc_id"]: row for row in mix(docs).collect()}
    before = 0
    for i in sorted(range(90), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()):
        row = rows[i]
        whole, rest = divmod(int(row["target"]), row["source_size"])
        assert row["taken"] == whole * row["size"] + min(max(rest - before, 0), row["size"])
        before += row["size"]


def test_rows_do_not_depend_on_partitions(spark):
    docs = sized(documents(spark, [words(i, 5 + i) for i in range(40)]))
    assert sorted(mix(docs).collect(), key=str) == sorted(mix(docs.repartition(7)).collect(), key=str)


def test_empty_table_and_no_words(spark):
    assert mix(sized(documents(spark, []))).collect() == []
    assert {row["taken"] for row in mix(sized(documents(spark, [None, "", " "]).filter("text <> 'no id' or text is null"))).collect()} == {0}


def test_first_words(spark):
    rows = [("a b  c\nd", 2), ("  a\tb c", 1), ("ünï  cödé x" + " y" * 20_000, 20_000), ("a b", 1)]
    got = spark.createDataFrame(rows, "t string, n int").select(first_words(F.col("t"), F.col("n"))).collect()
    assert [row[0] for row in got] == ["a b", "  a", "ünï  cödé x" + " y" * 19_997, "a"]
