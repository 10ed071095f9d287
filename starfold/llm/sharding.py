"""Sharding by a hierarchical weighted hash tree.

Regions hold racks and racks hold shards. A row walks down from the root: at each level every child draws
``ln(u) / weight`` with ``u`` hashed from the row's key and the child's name, and the largest draw wins, so a child wins
in proportion to its weight. The weight of a region or rack is the sum of what it holds. A draw depends on nothing but
the key and that child: a changed weight moves rows into or out of that child's subtree only.

Null keys are a key like any other. Rows with equal keys share a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows are numbered within hash buckets first: one bucket is the most that a single task orders.
SLOT_BUCKETS = 4096
# Equal rows get their numbers in pieces of at most so many.
SLOTS_AT_ONCE = 65536


@dataclass(frozen=True)
class Node:
    """A shard (no children) or a group of nodes. Names are unique in a tree."""

    name: str
    children: tuple[Node, ...] = ()
    own_weight: float = 1.0
    shard: int | None = None

    @property
    def weight(self) -> float:
        return sum(child.weight for child in self.children) if self.children else self.own_weight


def even_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 2) -> Node:
    """A tree of ``shards`` shards of weight 1, numbered from 0; what is left over gets a region of its own.

    One shard more than a full tree is thus a new region: old subtrees keep their weights and only lose rows to it.
    """
    per_region = racks_per_region * shards_per_rack
    regions = []
    for first in range(0, shards, per_region):
        ids = range(first, min(first + per_region, shards))
        racks = tuple(
            Node(f"rack{low}", tuple(Node(f"shard{i}", shard=i) for i in ids if low <= i < low + shards_per_rack))
            for low in range(first, first + len(ids), shards_per_rack)
        )
        regions.append(Node(f"region{first}", racks))
    return Node("root", tuple(regions))


def draw(key: Column, node: Node) -> Column:
    """ln(u) / weight, u in (0, 1) from 52 hashed bits: the largest of such draws is each child's in proportion."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 12)
    return F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / F.lit(float(node.weight))


def shard_of(key: Column, tree: Node) -> Column:
    """The shard that a key descends to; children of weight 0 are never chosen."""
    if not tree.children:
        return F.lit(tree.shard)
    open_children = [child for child in tree.children if child.weight > 0]
    if not open_children:
        raise ValueError(f"nothing below {tree.name} has weight")
    if len(open_children) == 1:
        return shard_of(key, open_children[0])
    draws = F.array(*(draw(key, child) for child in open_children))
    winner = F.array_position(draws, F.array_max(draws))
    steps = F
    for place, child in enumerate(open_children, 1):
        steps = steps.when(winner == place, shard_of(key, child))
    return steps


def hash_tree_shards(docs: DataFrame, tree: Node, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; no shuffle. A column named ``out`` is replaced."""
    return docs.withColumn(out, shard_of(F.col(key), tree).cast("int"))


def numbered(rows: DataFrame, group: str, order: list[str], out: str = "slot") -> DataFrame:
    """Gapless numbers from 0 within ``group``, for a table of few groups and any number of rows.

    Returns ``group``, ``order`` and ``out``. Equal rows are counted before they are shuffled and dealt out again after
    it, in pieces of bounded size however many they are. Rows fall into a fixed number of hash buckets, each ordered on its own; the buckets' counts, a table of
    ``SLOT_BUCKETS`` rows a group, give where each bucket starts. Numbers depend on the rows alone.
    """
    columns = [group, *order]
    bucket = F.pmod(F.xxhash64(*order), F.lit(SLOT_BUCKETS)).alias("__bucket")
    equal = rows.groupBy(*columns).agg(F.count("*").alias("__n")).select(*columns, "__n", bucket)
    in_bucket = F.expr(f"sum(__n) over (partition by `{group}`, __bucket order by {', '.join(f'`{c}`' for c in order)})")
    ranked = equal.withColumn("__upto", in_bucket)
    totals = equal.groupBy(group, "__bucket").agg(F.sum("__n").alias("__total"))
    starts = totals.select(
        F.col(group).alias("__group"),
        F.col("__bucket").alias("__at"),
        F.expr(f"sum(__total) over (partition by `{group}` order by __bucket) - __total").alias("__start"),
    )
    placed = ranked.join(starts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__bucket") == F.col("__at")))
    first = F.col("__start") + F.col("__upto") - F.col("__n")
    last, step = first + F.col("__n") - 1, F.lit(SLOTS_AT_ONCE)
    pieces = placed.select(*columns, last.alias("__last"), F.explode(F.sequence(first, last, step.cast("long"))).alias("__piece"))
    return pieces.select(*columns, F.explode(F.sequence("__piece", F.least("__last", F.col("__piece") + step - 1))).alias(out))
