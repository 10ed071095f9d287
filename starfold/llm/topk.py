"""Exact top-k search by sequential reads of sorted lists, without random access.

A shard keeps one list per component, sorted by value. A query reads the lists of its positive components from the top,
those of its negative ones from the bottom, all to the same depth. What has been read of a vector is known; what has not
lies between the last value read of its list and the list's far end, which bounds the vector's score from both sides.
Each step reads on in all lists, adds what was read to the lower bounds of the vectors met, and takes it from what is unread
of them. A vector whose upper bound is below the k-th best lower bound is an outsider for good. Reading ends when few enough
vectors are not outsiders; only then are their rows looked up, and their scores resolved. Many queries read together, so
that an entry is read once for all of them.

Components are whole numbers, so all sums are exact. Where values are spread evenly over the lists, bounds come close late
and most of the lists is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.vectors import search, usable

# A step reads this share of a list.
STEP = 1 / 8
# Reading ends when at most so many times k vectors can still be among the best.
RESOLVED_TIMES_K = 12
QUERIES_AT_ONCE = 256


class Lists:
    """A shard's vectors as one list per component, the largest value first."""

    def __init__(self, rows: np.ndarray, kind: type = np.float64):
        self.rows = rows.astype(np.int64)
        self.members = np.argsort(-rows, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(rows.T, self.members, axis=1).astype(kind)
        self.count, self.kind = len(rows), kind

    def open(self, queries: np.ndarray, k: int, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Some queries' numbers, which vectors (rows) may be among the ``k`` best of each (columns), entries read of a list.

        ``own`` is the place of a query's own vector, or -1. All queries read together: an entry is read once for all of them.
        """
        asking = np.arange(len(queries))
        mine = np.flatnonzero(own >= 0)
        left = np.full((self.count, len(queries)), True)
        left[own[mine], mine] = False
        if self.count <= RESOLVED_TIMES_K * k:
            yield asking, left, 0
            return
        # Each list twice: as read from the top, for positive components, and from the bottom, for negative ones.
        lists = len(self.values)
        far = np.concatenate([self.values[:, -1], self.values[:, 0]])
        weights = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1).astype(self.kind).T
        lower = np.repeat((far @ weights)[None, :], self.count, axis=0)
        lower[own[mine], mine] = -np.inf
        unread = np.ones((self.count, 2 * lists), self.kind)
        step, depth = max(1, round(STEP * self.count)), 0
        while len(asking):
            before, depth = depth, min(depth + step, self.count)
            top, bottom = slice(before, depth), slice(self.count - depth, self.count - before)
            met = np.concatenate([self.members[:, top], self.members[:, bottom]])
            values = np.concatenate([self.values[:, top], self.values[:, bottom]])
            gained = np.zeros_like(unread)
            gained[met, np.arange(2 * lists)[:, None]] = values - far[:, None]
            unread[met, np.arange(2 * lists)[:, None]] = 0
            lower += gained @ weights
            last = np.concatenate([self.values[:, depth - 1], self.values[:, self.count - depth]])
            bar = np.partition(lower.T, -k, axis=1)[:, -k]
            left = lower + unread @ ((last - far)[:, None] * weights) >= bar
            done = left.sum(axis=0) <= (RESOLVED_TIMES_K * k if depth < self.count else self.count)
            if done.any():
                yield asking[done], left[:, done], depth
                asking, lower, weights = asking[~done], lower[:, ~done], weights[:, ~done]


def top_in_shard(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """Each query's best ``k`` of one shard (see ``vectors.Search``)."""
    largest = np.abs(rows).max(initial=0) * np.abs(queries).max(initial=0) * rows.shape[1]
    # A type in which twice the largest possible score is exact.
    lists = Lists(rows, np.float32 if 2 * largest < 1 << 24 else np.float64)
    own = np.searchsorted(ids, query_ids)
    own = np.where((own < len(ids)) & (ids[np.minimum(own, len(ids) - 1)] == query_ids), own, -1)
    out_place, out_id, out_score = [], [], []
    for low in range(0, len(queries), QUERIES_AT_ONCE):
        block = slice(low, low + QUERIES_AT_ONCE)
        for numbers, left, _ in lists.open(queries[block], k, own[block]):
            for number, open_ in zip(low + numbers, left.T):
                found = np.flatnonzero(open_)
                scores = lists.rows[found] @ queries[number].astype(np.int64)
                keep = np.lexsort((ids[found], -scores))[:k]
                out_place.append(np.full(len(keep), number))
                out_id.append(ids[found[keep]])
                out_score.append(scores[keep])
    return np.concatenate(out_place), np.concatenate(out_id), np.concatenate(out_score)


def top_scores(vectors: DataFrame, is_query: str, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: float = 1.0) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` largest inner products of floor(``scale`` * x), exactly.

    ``is_query`` is an SQL condition on ``id``. Rows without id, and vectors that are null or hold null or non-finite
    components, take no part; zero vectors do. Fewer than ``k`` candidates are all returned. Scores must be below 2^53.
    """
    whole = usable(vectors, key, vector, zero=True).select(
        "id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v")
    )
    find = lambda *block: top_in_shard(*block, k)
    return search(whole, is_query, find, k, "long")
