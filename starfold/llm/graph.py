"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.recovery import written


def _toward_least(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """One star step: each node's neighbours are linked to the least node it knows.

    The small step looks at smaller neighbours, the large step links the larger ones.
    """
    if smaller_only:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        near = near.unionByName(near.select("u", F.col("u").alias("v")))
    else:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("u", "v")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("w", "m").alias("m"))
    joined = near.join(least, F.col("u") == F.col("w"))
    if not smaller_only:
        joined = joined.filter("v > u")
    return joined.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node``, ``root`` (the least node reachable) for every node of ``edges`` (``a``, ``b``, of one orderable type) but the roots.

    Alternating star steps; the number of rounds grows with the logarithm of the size. Every round is a table in the
    shared folder. Loops and repeated edges do no harm; an empty table has no components.
    """
    edges = written(edges.filter("a <> b").select("a", "b").distinct(), label)
    state = None
    while True:
        edges = written(_toward_least(_toward_least(edges, False), True), label)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
