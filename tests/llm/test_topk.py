import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seclake.llm import topk


def brute(rows, k, scale, is_query):
    ints = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ints if i is not None and is_query(i)}):
        asks = min(v for i, v in ints if i == q)
        scores = sorted(((-sum(a * b for a, b in zip(asks, v)), c is None, c or 0) for c, v in ints if c != q))
        out += [(q, r, None if none else c, -s) for r, (s, none, c) in enumerate(scores[:k], 1)]
    return out


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(topk, "QUERY_GROUP", 7)
    monkeypatch.setattr(topk, "CANDIDATE_GROUP", 40)
    monkeypatch.setattr(topk, "BINS", 300)  # so that windows are refined several times


def run(spark, rows, k=10, mod=10):
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, row string")
    got = topk.top_k(df, F.col("vec_id") % mod == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def test_random_ties_and_odd_rows(spark, small):
    draw = random.Random(1)
    vec = lambda: [float.fromhex(f"0x1p-{draw.randint(1, 3)}") * draw.choice([-1, 1, 2, 0]) for _ in range(5)]
    rows = [(i, vec()) for i in range(150)] + [(1000 + i, [0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(100)]
    rows += [(300, None), (310, [float("nan")] * 5), (320, [None, 1.0]), (330, [float("inf")] * 5), (None, vec()), (None, vec()), (350, []), (360, [1.0]), (0, vec()), (20, [3.0] * 5)]
    assert run(spark, rows) == brute(rows, 10, 1024, lambda i: i % 10 == 0)


def test_fewer_candidates_than_k(spark, small):
    rows = [(0, [1.0, 2.0]), (1, [1.0, -2.0]), (10, [0.0, 0.0])]
    assert run(spark, rows) == brute(rows, 10, 1024, lambda i: i % 10 == 0)
    assert run(spark, [(0, [1.0])]) == []


def test_wide_scores(spark, small):
    draw = random.Random(3)
    rows = [(i, [30000.0 + i, -1000.0 * i]) for i in range(40)]
    assert run(spark, rows) == brute(rows, 10, 1024, lambda i: i % 10 == 0)
    for most in (1e5, 1e6):
        rows = [(i, [draw.uniform(-most, most) for _ in range(3)]) for i in range(60)] + [(101, [40000.0, 0.0, 0.0]), (102, [50000.0, 0.0, 0.0]), (100, [1.0, 0.0, 0.0])]
        rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
        assert run(spark, rows) == brute(rows, 10, 1024, lambda i: i % 10 == 0)
    small_query = [(0, [0.001, 0.0]), (1, [float(2**45), 1.0]), (2, [float(2**45 + 2**22), 1.0])]
    assert run(spark, small_query, mod=100) == brute(small_query, 10, 1024, lambda i: i == 0)
    with pytest.raises(ValueError, match="64 bits"):
        run(spark, [(0, [1e30]), (1, [1e30])])


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0]), (2, [1.0])]) == []
