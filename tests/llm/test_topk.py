import math
import random

import pytest
from pyspark.sql import functions as F

from quillspark.llm import topk as K


def brute(rows, k):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, q in ok:
        if i % 100 == 0 and i not in out:
            s = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i))[:k]
            out[i] = [(r, j, -x) for r, (x, j) in enumerate(s, 1)]
    return out


def test_exact_over_blocks(spark):
    r = random.Random(1)
    rows = [(i, [float(round(r.gauss(0, 1), r.choice([0, 3]))) for _ in range(8)]) for i in range(500)]
    rows += [(i, list(rows[i % 7][1])) for i in range(500, 540)]  # ties
    rows += [(700, None), (701, [1.0, None]), (800, [math.nan] * 8), (801, [math.inf] * 8), (None, [1.0] * 8), (600, [0.0] * 8), (802, [5.0, 5.0]), (900, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    for block, q_block, k in ((8192, 4096, 10), (50, 2, 10), (5, 1, 3), (8192, 4096, 1000)):
        got = {}
        for x in K.top_k(df, F.col("vec_id") % 100 == 0, k, block=block, query_block=q_block).collect():
            got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
        assert {q: sorted(v) for q, v in got.items()} == brute(rows, k)


def test_repeated_ids_and_nothing(spark):
    rows = [(100, [1.0]), (100, [1.0]), (1, [2.0]), (1, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((x["rank"], x["vec_id"], x["score"]) for x in K.top_k(df, F.col("vec_id") % 100 == 0).collect())
    assert got == [(1, 1, 3 * 1024 * 1024), (2, 1, 2 * 1024 * 1024)]
    assert K.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_ids_of_text_and_too_large_components(spark):
    r = random.Random(4)
    rows = [(f"v{i:03}", [float(r.randint(-9, 9)) for _ in range(4)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<float>")
    want = {}
    for i, q in rows:
        if i.endswith("0"):
            s = sorted((-(1024 * 1024) * int(sum(a * b for a, b in zip(q, v))), j) for j, v in rows if j != i)[:5]
            want[i] = [(n, j, -x) for n, (x, j) in enumerate(s, 1)]
    for block in (8192, 7):
        got = {}
        for x in K.top_k(df, F.col("vec_id").endswith("0"), 5, block=block).collect():
            got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
        assert {q: sorted(v) for q, v in got.items()} == want
    with pytest.raises(Exception, match="too large"):
        K.top_k(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>"), F.lit(True)).collect()


def test_reading_stops_early(monkeypatch):
    """With one candidate far ahead of the others, bounds leave it alone long before the lists end."""
    import numpy as np

    r = np.random.default_rng(3)
    v = r.integers(-100, 100, (4000, 8)).astype(float)
    v[17] = 1000
    monkeypatch.setattr(K, "STEPS", (8, 0))  # a second step would divide by nothing
    (at, score), = K.SortedLists(v).top(np.full((1, 8), 3.0), [np.zeros(0, dtype=int)], 1, [None])
    assert at.tolist() == [17] and score.tolist() == [24000]


def test_bounds_hold():
    """At every depth each row's score is between its bounds, and both are the score where lists end."""
    import numpy as np

    r = np.random.default_rng(5)
    v, q = r.integers(-50, 50, (200, 6)).astype(float), r.integers(-9, 9, (5, 6)).astype(float)
    lists, split = K.SortedLists(v), np.hstack([np.maximum(q, 0), np.minimum(q, 0)])
    for depth in (1, 20, 77, 199, 200):
        above, edge, below, worst = lists.read(depth)
        upper, lower = above @ split.T + split @ edge, below @ split.T + split @ worst
        assert (lower <= v @ q.T).all() and (v @ q.T <= upper).all()
    assert (upper == lower).all()


def test_large_components_stay_exact(spark):
    big = float(2**30)
    rows = [(100, [big, 1.0, big]), (1, [big, 3.0, big]), (2, [big, 2.0, big]), (3, [big, 2.0, -big])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(x["rank"], x["vec_id"], x["score"]) for x in K.top_k(df, F.col("vec_id") == 100, 3, scale=1).orderBy("rank").collect()]
    assert got == [(1, 1, 2 * 2**60 + 3), (2, 2, 2 * 2**60 + 2), (3, 3, 2)]
