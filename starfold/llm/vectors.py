"""Queries against all vectors, in blocks of bounded size.

The vectors are dealt to shards and the queries to blocks by hashed id; each pair of a shard and a block is one task that
returns each query's best within the shard, and the best of all shards are merged. A row's own vector is no candidate of
its query. Vectors of another length are never compared. Shards and blocks hold a fixed number of rows on average, so a
task's memory is bounded whatever the input; equal vectors are spread like any others.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_ROWS = 8192
BLOCK_QUERIES = 16384

# (query ids, query rows, vector ids, vector rows) -> (place of the query, vector id, score) of each query's best.
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def usable(vectors: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """``id`` and ``v`` (doubles) of the rows whose vector is not null and whose components are all finite numbers.

    ``zero`` tells whether all-zero vectors stay. A row without id takes no part either: it could not be named.
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)
    return kept if zero else kept.filter(F.exists("v", lambda x: x != 0))


def _dealt(column: str, parts: int):
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def search(
    vectors: DataFrame, is_query: str, find: Search, k: int, score: str,
    shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the best ``k`` of each query, ties to the smaller id."""
    total, asked = vectors.agg(F.count("*"), F.count(F.when(F.expr(is_query), 1))).first()
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-asked // block_queries))
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    length = F.size("v").alias("dims")
    stored = vectors.select("id", "v", length, _dealt("id", shards).alias("shard"), every(blocks).alias("block"))
    queries = vectors.filter(is_query).select("id", "v", length, _dealt("id", blocks).alias("block"), every(shards).alias("shard"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64() if score == "long" else pa.float64())])

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        (ids, rows), (query_ids, query_rows) = matrix(left), matrix(right)
        place, found, scores = find(query_ids, query_rows, ids, rows)
        return pa.table([query_ids[place], found, scores], schema=schema)

    keys = ("dims", "shard", "block")
    pairs = stored.groupBy(*keys).cogroup(queries.groupBy(*keys))
    local = pairs.applyInArrow(best, f"query_id long, vec_id long, score {score}")
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    return local.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors in the order of ids."""
    ids = table.column("id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    return ids[order], flat.reshape(len(ids), -1)[order]
