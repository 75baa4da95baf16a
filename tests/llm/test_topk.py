"""Top-k search against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from folio.llm import topk


def brute(rows, k):
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in fine if i is not None and i % 2 == 0}):
        q = min(v for j, v in fine if j == i)
        score = lambda v: max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(q, v))))
        got = sorted(((-score(v), j is None, j or 0) for j, v in fine if j != i and len(v) == len(q)))[:k]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(got)]
    return sorted(out, key=str)


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(3)
    got = topk.search(df, F.col("vec_id") % 2 == 0, **kw).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, kw.get("k", 5))


def test_random_ties_and_hot_vector(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 8).astype(np.float32).tolist()) for i in range(60)]
    rows += [(i, [0.25] * 8) for i in range(60, 160)]  # a third and more are one vector
    check(spark, rows)
    check(spark, rows, k=3, block=7)


def test_odd(spark):
    rows = [(1, None), (2, [1.0, None]), (4, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (8, [0.0, -1.0]), (8, [0.5, 0.5]), (9, [1.0, 1.0]), (9, [1.0, 1.0]), (None, [3.0, 3.0]), (10, [1.0]), (12, []), (-2, [-0.001, 0.3])]
    check(spark, rows)
    check(spark, [(i, [s * 1e30, 1.0]) for i, s in enumerate((1, 1, -1, 0.5, 2))])
    check(spark, [(2, [1.0])])
    check(spark, [])
