import numpy as np
import pytest

from starfold.llm import collision, topk
from starfold.llm.queries import op3_collision_neighbours, op6_exact_top_scores

SF = "/root/testdata/sf0.001"
QUERY = "id % 20 = 0"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 7, "x") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, id string")


def gaussian(count, dims, seed=1):
    return np.random.default_rng(seed).normal(size=(count, dims)).astype(np.float32)


def ranking(ids, rows, k, whole=False):
    """Best ids and scores of every twentieth id, by all products."""
    x = np.floor(64 * rows.astype(np.float64)).astype(np.int64) if whole else rows.astype(np.float64)
    best = {}
    for place in np.flatnonzero(ids % 20 == 0):
        scores = (x * x[place]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if i != place][:k]
        best[int(ids[place])] = [(int(ids[i]), scores[i].item()) for i in order]
    return best


def got(df):
    best = {}
    for row in sorted(df.collect(), key=lambda row: (row["query_id"], row["rank"])):
        best.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert row["rank"] == len(best[row["query_id"]])
    return best


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_top_scores_are_exact(spark, monkeypatch, shard_rows):
    rows = gaussian(400, 16)
    rows[50:80] = rows[20]
    rows[90] = 0
    real = topk.search
    monkeypatch.setattr(topk, "search", lambda *args: real(*args, shard_rows=shard_rows, block_queries=7))
    assert got(topk.top_scores(table(spark, rows), QUERY, scale=64)) == ranking(np.arange(400), rows, 20, whole=True)


def test_top_scores_beyond_single_precision(spark):
    rows = gaussian(100, 8) * 5_000
    assert got(topk.top_scores(table(spark, rows), QUERY, k=5, scale=64)) == ranking(np.arange(100), rows, 5, whole=True)


def test_lists_are_read_until_outsiders_are_known():
    # Few large components in a vector: the best are met at the heads of the lists.
    draws = np.random.default_rng(4)
    rows = np.floor(draws.pareto(1.0, (3000, 12)))
    queries = np.stack([np.eye(12)[3], rows[7], rows[8] * (np.arange(12) < 5), np.zeros(12)])
    seen = {}
    for numbers, left, depth in topk.Lists(rows).open(queries, 20, np.array([-1, 7, -1, -1])):
        for number, open_ in zip(numbers, left.T):
            seen[number] = depth
            scores = rows @ queries[number]
            scores[7] = -np.inf if number == 1 else scores[7]
            assert open_[scores >= np.sort(scores)[-20]].all() and not (number == 1 and open_[7])
    assert sorted(seen) == [0, 1, 2, 3] and max(seen[0], seen[1], seen[2]) < 1500 and seen[3] == 3000


@pytest.mark.parametrize("count", [1, 2, 17, 250, 999])
def test_lists_of_any_length(count):
    rows = np.random.default_rng(count).integers(-3, 4, (count, 5)).astype(float)
    ids = np.arange(count)
    place, found, scores = topk.top_in_shard(ids[::20], rows[::20], ids, rows, 3)
    want = {i: [pair[0] for pair in best] for i, best in ranking(ids, rows / 64, 3, whole=True).items()}
    assert {int(ids[::20][p]): found[place == p].tolist() for p in range(len(ids[::20]))} == want


@pytest.mark.parametrize("search", [collision.nearest, topk.top_scores])
def test_vectors_that_take_no_part(spark, search):
    rows = [[1, 2], None, [], [1, None], [float("nan"), 1], [float("inf"), 1], [0, 0], [2, 1], [1, 2, 3], [3, 3]]
    ids = [0, 1, 2, 3, 4, 5, 20, 7, 40, None]
    best = got(search(table(spark, rows, ids), QUERY))
    zero = search is topk.top_scores
    assert best[0] == ([(7, 4), (20, 0)] if zero else [(7, 4.0)])
    assert (20 in best) == zero
    assert 40 not in best
    assert search(table(spark, []), QUERY).count() == 0
    assert search(table(spark, [[1, 2]], [20]), QUERY).count() == 0


def test_neighbours_of_few_are_all(spark):
    rows = gaussian(15, 6)
    best = got(collision.nearest(table(spark, rows), QUERY))
    assert [i for i, _ in best[0]] == [i for i, _ in ranking(np.arange(15), rows, 20)[0]]


def test_ties_go_to_the_smaller_id(spark):
    rows = np.tile(gaussian(1, 8), (100, 1))
    best = got(collision.nearest(table(spark, rows), QUERY))
    assert [i for i, _ in best[40]] == list(range(20)) and [i for i, _ in best[0]] == list(range(1, 21))


def recall(found, want):
    return np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


@pytest.mark.parametrize("shard_rows", [8192, 1000])
def test_recall(spark, monkeypatch, shard_rows):
    rows = gaussian(4000, 48)
    rows[::3] *= 2
    real = collision.search
    monkeypatch.setattr(collision, "search", lambda *args: real(*args, shard_rows=shard_rows))
    found = got(collision.nearest(table(spark, rows), QUERY))
    want = ranking(np.arange(4000), rows, 20)
    assert recall(found, want) >= 0.9
    for best in found.values():
        assert best == sorted(best, key=lambda pair: (-pair[1], pair[0]))


@pytest.mark.parametrize("query, whole", [(op3_collision_neighbours, False), (op6_exact_top_scores, True)])
def test_queries(spark, query, whole):
    stored = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids, rows = np.array([row["vec_id"] for row in stored]), np.array([row["embedding"] for row in stored])
    found, want = got(query(spark, SF)), ranking(ids, rows, 20, whole)
    assert found == want if whole else recall(found, want) >= 0.9
