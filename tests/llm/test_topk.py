import math
import random

import pytest

from orderlens.llm import topk as K

SCHEMA = "vec_id long, embedding array<double>, score string, id string"


def brute(rows, is_query, k, scale=64):
    use = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for (i, w), (_, v) in zip(use, [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]):
        if is_query(i) and (i not in asked or v < asked[i][0]):
            asked[i] = (v, w)
    out = []
    for q, (_, w) in asked.items():
        best = sorted((-sum(a * b for a, b in zip(w, c)), i) for i, c in use if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["dense", "ties", "sparse", "huge"])
def test_against_brute_force(spark, kind):
    rng = random.Random(kind)
    draw = {"dense": lambda: rng.gauss(0, 1), "ties": lambda: rng.choice([0.0, 0.5]), "huge": lambda: rng.choice([1e17, -3e18, 0.25]),
            "sparse": lambda: rng.choice([0.0] * 9 + [rng.random() * 5 - 1])}[kind]
    rows = [(rng.choice([i, i - 40]), [draw() for _ in range(rng.choice([8, 8, 8, 5]))]) for i in range(0, 400, 2)]
    rows += [(1001, None), (1003, [1.0, None]), (1005, [float("nan")]), (1007, [float("inf")]), (None, [1.0]), (1009, []), rows[3], rows[3]]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    got = K.top_k(df, df.filter("vec_id % 20 = 0 OR vec_id = 1009"), k=7, block_rows=9, group_blocks=3, chunk_queries=4)
    expected = brute(rows, lambda i: i % 20 == 0 or i == 1009, 7)
    if kind == "huge":       # sums beyond 64 bits are shown clipped
        top = (1 << 63) - 1
        expected = [(q, n, i, max(-top - 1, min(top, s))) for q, n, i, s in expected]
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == expected


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert K.top_k(df, df).count() == 0
    one = spark.createDataFrame([(20, [1.0], "", "")], SCHEMA)
    assert K.top_k(one, one).count() == 0


def test_blocks_are_skipped(monkeypatch):
    """A block whose bound is below the k-th best score is not read."""
    import numpy as np

    class Counted(np.ndarray):
        """Weights that count how often they are multiplied."""
        reads = 0

        def astype(self, *a, **k):
            type(self).reads += 1
            return super().astype(*a, **k).view(np.ndarray)

    far = np.full((4, 2), -100).view(Counted)
    near = np.array([[9, 9], [8, 8]])
    q = (np.array([0]), np.array([[1, 1]]))
    pack = lambda ids, w: (np.array(ids), w, w.max(axis=0)[None], w.min(axis=0)[None])
    at, ids, scores = K.best_of_cell(q, [pack([5, 6, 7, 8], far), pack([1, 2], near)], 2)
    assert ids.tolist() == [1, 2] and scores.tolist() == [18, 16] and Counted.reads == 0
    K.best_of_cell(q, [pack([5, 6, 7, 8], far), pack([1], near[:1])], 2)        # the second best is in the far block
    assert Counted.reads == 1
