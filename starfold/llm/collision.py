"""Approximate nearest neighbours by collision counting over single projections.

A shard keeps each of a number of random projections of its vectors as one sorted array. A query's window on every array
is centred on the query's own projection, and is widened step by step, which is a hash table of ever wider buckets without
rehashing. A vector collides once for each window that it is in. Those with collisions in enough windows are verified by
their inner product, and the windows stop widening when enough vectors have been.

Largest inner products become least distances by one more component, which brings all vectors of a shard to the length of
the longest. Equal vectors have equal projections and are verified together, however many.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from starfold.llm.vectors import search, usable

PROJECTIONS = 128
# A vector is verified when it is within the windows of this share of the projections ...
THRESHOLD = 0.5
# ... and the search ends when this share of the shard has been verified, or this many times k.
VERIFIED_SHARE = 0.08
VERIFIED_TIMES_K = 30
# The windows begin with a half width of this many deviations of the projections, and widen by this factor.
FIRST_WIDTH = 0.3
WIDENING = 1.1
SEED = 20260


def projections(length: int) -> np.ndarray:
    """Random directions in columns, orthogonal within each run of ``length``: together they tell distances better."""
    draws = np.random.default_rng(SEED)
    bases = [np.linalg.qr(draws.standard_normal((length, length)))[0] for _ in range(-(-PROJECTIONS // length))]
    return np.hstack(bases)[:, :PROJECTIONS] * np.sqrt(length)


def nearest_in_shard(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """Each query's best ``k`` of one shard (see ``vectors.Search``)."""
    scaled, asked = rows / np.abs(rows).max(), queries / np.abs(queries).max(axis=1, keepdims=True)
    norms = np.einsum("ij,ij->i", scaled, scaled)
    longest = norms.max()
    lifted = np.c_[scaled, np.sqrt(np.maximum(longest - norms, 0))]
    lengths = np.sqrt(np.einsum("ij,ij->i", asked, asked))
    centred = np.c_[asked * (np.sqrt(longest) / lengths)[:, None], np.zeros(len(asked))]
    directions = projections(lifted.shape[1])
    hashed = (lifted @ directions).T
    order = np.argsort(hashed, axis=1, kind="stable")
    hashed = np.take_along_axis(hashed, order, axis=1)
    wanted = centred @ directions
    # One array for all projections, each shifted past the one before, finds all windows' ends in one search.
    step = 4 * max(np.abs(hashed).max(), np.abs(wanted).max()) + 1
    shifts = np.arange(PROJECTIONS) * step
    flat = (hashed + shifts[:, None]).ravel()
    first = np.arange(PROJECTIONS) * len(ids)
    # A vector is in a window if its place in the sorted array is; places are what is counted.
    narrow = np.uint16 if len(ids) < 1 << 16 else np.uint32
    places = np.empty(hashed.shape, narrow)
    np.put_along_axis(places, order, np.arange(len(ids), dtype=narrow)[None, :], axis=1)
    enough = min(len(ids), max(VERIFIED_TIMES_K * (k + 1), int(VERIFIED_SHARE * len(ids))))
    threshold = int(np.ceil(THRESHOLD * PROJECTIONS))
    own = np.searchsorted(ids, query_ids)
    out_place, out_id, out_score = [], [], []
    width = np.sqrt(longest) * FIRST_WIDTH
    for place, centre in enumerate(wanted + shifts):
        # Begin a step below where the query before has ended.
        width /= WIDENING
        while True:
            low = np.maximum(np.searchsorted(flat, centre - width) - first, 0).astype(narrow)
            high = np.minimum(np.searchsorted(flat, centre + width, side="right") - first, len(ids))
            inside = places - low[:, None] < np.maximum(high - low, 0).astype(narrow)[:, None]
            candidates = np.flatnonzero(np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8) >= threshold)
            if len(candidates) >= enough:
                break
            width *= WIDENING
        if own[place] < len(ids) and ids[own[place]] == query_ids[place]:
            candidates = candidates[ids[candidates] != query_ids[place]]
        # Products summed row by row: equal vectors get equal scores.
        scores = (rows[candidates] * queries[place]).sum(axis=1)
        keep = np.lexsort((ids[candidates], -scores))[:k]
        out_place.append(np.full(len(keep), place))
        out_id.append(ids[candidates[keep]])
        out_score.append(scores[keep])
    return np.concatenate(out_place), np.concatenate(out_id), np.concatenate(out_score)


def nearest(vectors: DataFrame, is_query: str, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: ``k`` vectors of about the largest inner product with each query.

    ``is_query`` is an SQL condition on ``id``. Rows without id, and vectors that are null, zero, or hold null or non-finite
    components, take no part. Fewer than ``k`` candidates are all returned.
    """
    find = lambda *block: nearest_in_shard(*block, k)
    return search(usable(vectors, key, vector, zero=False), is_query, find, k, "double")
