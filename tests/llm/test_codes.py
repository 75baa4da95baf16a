"""Codebooks by bounds against plain Lloyd rounds in Python's whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from folio.llm import codes


def plain(rows, scale=4096, parts=8, entries=16, rounds=6):
    fine = [(i, l, [math.floor(max(-(2.0**52), min(2.0**52, scale * float(np.float32(x))))) for x in v]) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for d in {len(v) for _, _, v in fine}:
        w = -(-d // parts)
        own = [(i, l, v + [0] * (w * parts - d), v) for i, l, v in fine if len(v) == d]
        first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[3]))[:entries]
        cut = lambda v, p: v[p * w : (p + 1) * w]
        books = [[cut(r[2], p) for r in first] for p in range(parts)]
        far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
        near = lambda x, book: min((far(x, c), e) for e, c in enumerate(book))
        for _ in range(rounds):
            for p in range(parts):
                at = [[] for _ in books[p]]
                for r in own:
                    at[near(cut(r[2], p), books[p])[1]].append(cut(r[2], p))
                books[p] = [[sum(c) // len(g) for c in zip(*g)] if g else e for e, g in zip(books[p], at)]
        name = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for r in own:
            got = [near(cut(r[2], p), books[p]) for p in range(parts)]
            out.append((r[0], r[1], "".join(f"{e:02x}" for _, e in got), min(sum(x for x, _ in got), 2**63 - 1), name))
    total = {}
    for r in out:
        total[r[1]] = total.get(r[1], 0) + r[3]
    return sorted(((*r[:4], min(total[r[1]], 2**63 - 1), r[4]) for r in out), key=str)


def check(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, d int").repartition(3)
    got = codes.compress(df, **kw).select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, **kw)


def test_random_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.2, 16).astype(np.float32).tolist(), i % 5 or None) for i in range(200)]
    check(spark, rows)
    check(spark, rows, entries=40, rounds=3)


def test_ties_and_a_hot_vector(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.integers(-2, 3, 16) / 4096).tolist(), 1) for i in range(150)]  # small whole numbers: distances are often equal
    check(spark, rows + [(1000 + i, [0.25] * 16, 1) for i in range(100)])


def test_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [0.5, -0.001], None), (5, [0.25, 0.0], 2), (None, [1.0, 1.0], 2), (None, [0.0, 1.0], 2), (6, [1e30, -1e30], 3), (7, [-1e30, 1e30], 3), (8, [], 4), (9, [1.0] * 11, 4)]
    check(spark, rows)
    check(spark, [])
    check(spark, [(1, [1.0] * 8, None)])
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), entries=300)


def test_bounds_skip_most_of_the_work_and_change_nothing():
    rng = np.random.default_rng(7)
    middle = rng.normal(0, 1, (16, 8)) * 4096
    x = np.floor(middle[rng.integers(0, 16, 4000)] + rng.normal(0, 100, (4000, 8))).astype(np.int64)
    book = np.floor(middle).astype(np.int64)
    of = codes.grouped(book, 4)
    at, low, drift, done = np.zeros(4000, np.int64), np.zeros((4000, of.max() + 1)), np.zeros(16), []
    for _ in range(4):
        at, low, near, scanned = codes.assign(x, at, low, book, of, drift)
        done.append(scanned)
        d = ((x[:, None] - book[None]) ** 2).sum(-1)
        assert (at == d.argmin(1)).all() and (near == d.min(1)).all()
        for g in range(low.shape[1]):
            others = np.where((of == g)[None] & (np.arange(16)[None] != at[:, None]), np.sqrt(d), np.inf)
            assert (low[:, g] <= others.min(1) * (1 + 1e-9)).all()
        new = np.stack([x[at == e].sum(0) // max(1, (at == e).sum()) if (at == e).any() else book[e] for e in range(16)])
        drift, book = np.sqrt(((new - book) ** 2).sum(1).astype(float)), new
    assert done[0] > 30_000 and done[-1] < done[0] / 3
