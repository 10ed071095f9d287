import math
import struct
import zlib

import pytest
import xxhash
from messy import documents
from pyspark.sql import functions as F

from starfold.llm import sharding
from starfold.llm.queries import op7_hash_tree_shards
from starfold.llm.sharding import Node, even_tree, hash_tree_shards, numbered

SF = "/root/testdata/sf0.001"


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "doc_id")


def counts(df):
    return {row[0]: row[1] for row in df.groupBy("shard").count().collect()}


def plain_shard(key, tree):
    """The shard that a whole-number or null key descends to, with every draw worked out by itself."""
    here = tree
    while here.children:
        best = None
        for child in here.children:
            if child.weight > 0:
                seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
                bits = xxhash.xxh64_intdigest(child.name.encode(), seed) >> 12
                drawn = math.log((bits + 0.5) / 2**52) / child.weight
                best = max(best or (-math.inf,), (drawn, child), key=lambda pair: pair[0])
        here = best[1]
    return here.shard


def test_descents_are_those_of_plain_draws(spark):
    uneven = Node("root", (
        Node("east", (Node("e1", (Node("s0", own_weight=1, shard=0), Node("s1", own_weight=3, shard=1))), Node("e2", (Node("s2", own_weight=0.5, shard=2),)))),
        Node("west", (Node("w1", (Node("s3", own_weight=4, shard=3), Node("s4", own_weight=0, shard=4))),)),
    ))
    keys = [*range(-200, 1500), 2**40, None]
    docs = spark.createDataFrame([(key,) for key in keys], "doc_id long")
    for tree in (even_tree(8), even_tree(9), even_tree(3), uneven):
        found = {row["doc_id"]: row["shard"] for row in hash_tree_shards(docs, tree).collect()}
        assert found == {key: plain_shard(key, tree) for key in keys}
    rows = op7_hash_tree_shards(spark, SF).select("doc_id", "shard", "grown_shard").collect()
    assert all(row["shard"] == plain_shard(row["doc_id"], even_tree(8)) for row in rows)
    assert all(row["grown_shard"] == plain_shard(row["doc_id"], even_tree(9)) for row in rows)


@pytest.mark.parametrize("at_once", [1, 7, 65536])
def test_many_equal_rows_are_numbered_in_pieces(spark, monkeypatch, at_once):
    monkeypatch.setattr(sharding, "SLOTS_AT_ONCE", at_once)
    rows = spark.createDataFrame([(0, 5)] * 22 + [(0, 6), (1, 5), (1, None), (1, None)], "shard int, doc_id long")
    found = sorted((tuple(row) for row in numbered(rows, "shard", ["doc_id"]).collect()), key=str)
    assert len(found) == 26 and sorted(row[2] for row in found if row[0] == 0) == list(range(23))
    assert sorted(row[2] for row in found if row[0] == 1) == [0, 1, 2]


def test_shares_follow_weights(spark):
    tree = Node("root", (
        Node("east", (Node("e1", (Node("s0", own_weight=1, shard=0), Node("s1", own_weight=3, shard=1))),)),
        Node("west", (Node("w1", (Node("s2", own_weight=4, shard=2), Node("s3", own_weight=0, shard=3))),)),
    ))
    found = counts(hash_tree_shards(ids(spark, 40_000), tree))
    assert set(found) == {0, 1, 2}
    for shard, share in {0: 0.125, 1: 0.375, 2: 0.5}.items():
        assert found[shard] / 40_000 == pytest.approx(share, abs=0.01)


def test_a_changed_weight_moves_rows_of_its_subtree_only(spark):
    def tree(weight):
        return Node("root", (
            Node("east", (Node("e1", (Node("s0", shard=0), Node("s1", shard=1))), Node("e2", (Node("s2", own_weight=weight, shard=2),)))),
            Node("west", (Node("w1", (Node("s3", shard=3), Node("s4", shard=4))),)),
        ))

    before = hash_tree_shards(ids(spark, 20_000), tree(1.0), out="before")
    moved = hash_tree_shards(before, tree(2.0), out="after").filter("before <> after").select("before", "after").distinct().collect()
    assert moved
    # Into the heavier rack, or into its region, never within the west or out of the east.
    assert all(row["after"] in (0, 1, 2) for row in moved)
    assert not any(row["before"] in (3, 4) and row["after"] in (3, 4) for row in moved)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    for shards in (4, 5, 8):
        placed = hash_tree_shards(ids(spark, 5_000), even_tree(shards))
        if shards % 4 == 0:
            grown = hash_tree_shards(placed, even_tree(shards + 1), out="grown")
            changed = {row["grown"] for row in grown.filter("grown <> shard").select("grown").distinct().collect()}
            assert changed == {shards}


def test_query_rows(spark):
    rows = op7_hash_tree_shards(spark, SF).collect()
    docs = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(row["doc_id"] for row in rows) == sorted(docs)
    slots = {}
    for row in rows:
        data = (docs[row["doc_id"]] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert row["grown_shard"] in (row["shard"], 8) and row["law"] == "key"
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_messy_rows_and_slots(spark):
    docs = hash_tree_shards(documents(spark).withColumn("shard", F.lit("clash")), even_tree(8))
    assert docs.filter("shard between 0 and 7").count() == docs.count()
    placed = numbered(docs, "shard", ["doc_id", "n_chars"]).collect()
    assert len(placed) == docs.count()
    for shard in {row["shard"] for row in placed}:
        own = sorted(row["slot"] for row in placed if row["shard"] == shard)
        assert own == list(range(len(own)))
    assert numbered(docs.limit(0), "shard", ["doc_id"]).count() == 0


def test_no_python_on_the_way(spark):
    plan = op7_hash_tree_shards(spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
