"""Steps and lines of pictures against plain versions, place by place."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.operators import raster
from folio.plans import rasters, registry

DIR = "/root/testdata/sf0.001"


def mirror(i, n):
    while not 0 <= i < n:
        i = -i if i < 0 else 2 * (n - 1) - i
    return i


def plain_blur(x, w, beyond):
    h, wd = len(x), len(x[0])
    r = len(w) // 2
    across = [[sum(w[k] * row[beyond(j + k - r, wd)] for k in range(len(w))) for j in range(wd)] for row in x]
    return [[(sum(w[k] * across[beyond(i + k - r, h)][j] for k in range(len(w))) + 2**31) // 2**32 for j in range(wd)] for i in range(h)]


def plain_adaptive(x):
    mean = plain_blur(x, raster.weights(35).tolist(), lambda i, n: min(max(i, 0), n - 1))
    return [[255 if v > m - 10 else 0 for v, m in zip(*rows)] for rows in zip(x, mean)]


def plain_unsharp(x):
    soft = plain_blur(x, raster.weights(7, 1.0).tolist(), mirror if min(len(x), len(x[0])) > 1 else lambda i, n: min(max(i, 0), n - 1))
    return [[min(255, max(0, (3 * v - s + 1) // 2)) for v, s in zip(*rows)] for rows in zip(x, soft)]


def plain_clahe(x):
    h, w = len(x), len(x[0])
    th, tw = -(-h // 8), -(-w // 8)
    area = th * tw
    curves = {}
    for a in range(8):
        for b in range(8):
            counts = [0] * 256
            for i in range(a * th, a * th + th):
                for j in range(b * tw, b * tw + tw):
                    counts[x[mirror(i, h)][mirror(j, w)]] += 1
            limit = max(1, 2 * area // 256)
            over = sum(max(0, c - limit) for c in counts)
            counts = [min(c, limit) + over // 256 for c in counts]
            rest = over % 256
            for k in range(rest):
                counts[k * max(256 // rest, 1)] += 1
            curve, held = [], 0
            for c in counts:
                held += c
                curve.append(min(255, (held * 510 + area) // (2 * area)))
            curves[a, b] = curve
    hold = lambda t: min(max(t, 0), 7)
    out = []
    for i in range(h):
        row = []
        a, fy = divmod(2 * i + 1 - th, 2 * th)
        for j in range(w):
            b, fx = divmod(2 * j + 1 - tw, 2 * tw)
            v = x[i][j]
            c = lambda p, q: curves[hold(p), hold(q)][v]  # noqa: E731, B023
            total = (2 * th - fy) * ((2 * tw - fx) * c(a, b) + fx * c(a, b + 1)) + fy * ((2 * tw - fx) * c(a + 1, b) + fx * c(a + 1, b + 1))
            row.append((2 * total + 4 * area) // (8 * area))
        out.append(row)
    return out


PLAIN = {"clahe": plain_clahe, "unsharp": plain_unsharp, "adaptive": plain_adaptive}


@pytest.mark.parametrize("size", [(16, 24), (17, 9), (9, 30), (2, 3), (40, 41)])
def test_steps_equal_plain_versions(size):
    image = np.random.default_rng(size[0]).integers(0, 256, size).astype(np.uint8)
    image[: size[0] // 2] //= 5  # a dark half
    for name, f in PLAIN.items():
        assert raster.STEPS[name](image).tolist() == f(image.tolist()), name


def test_pictures_of_one_row():
    for size in ((1, 1), (1, 12), (12, 1)):
        image = np.full(size, 77, np.uint8)
        assert (raster.unsharp(image) == 77).all() and (raster.adaptive(image) == 255).all() and raster.clahe(image).shape == size
        assert raster.grid_lines(image) == ([], [])


def test_query_of_steps_equals_plain_versions(spark):
    got = registry.queries()["raster_steps"](spark, DIR)
    rows = spark.read.parquet(f"{DIR}/embeddings.parquet").collect()
    vectors = {r.vec_id: r.embedding for r in rows}
    out = got.collect()
    assert len(out) == len(rows)
    digest = lambda x: hashlib.sha256(bytes(v for row in x for v in row)).hexdigest()
    for r in sorted(out, key=lambda r: r.vec_id)[:4]:
        side = len(vectors[r.vec_id])
        x = np.frombuffer(rasters.shaded(vectors[r.vec_id]), np.uint8).reshape(side, side).tolist()
        assert (r.clahe, r.unsharp, r.adaptive) == tuple(digest(PLAIN[n](x)) for n in ("clahe", "unsharp", "adaptive"))
        assert r.all_three == digest(plain_adaptive(plain_unsharp(plain_clahe(x))))


def test_runs_and_levels():
    marks = np.array([[1, 1, 0, 1, 1, 1], [0, 0, 0, 0, 0, 0], [1, 1, 1, 1, 1, 1]], bool)
    assert raster.long_runs(marks, 3).astype(int).tolist() == [[0, 0, 0, 1, 1, 1], [0] * 6, [1] * 6]
    image = np.array([[10, 12, 200], [11, 210, 205]], np.uint8)
    best = max(range(255), key=lambda t: (len(a := image[image <= t]) and len(b := image[image > t]) and len(a) * len(b) * (a.mean() - b.mean()) ** 2, -t))
    assert raster.dark_level(image) == best == 12
    assert raster.peaks(np.array([0, 6, 5, 6, 0, 0, 0, 0, 0, 0, 9])) == [2, 10] and raster.peaks(np.array([], int)) == [] and raster.peaks(np.full(9, 5)) == []
    assert [int(raster.weights(*a).sum()) for a in ((35,), (7, 1.0))] == [65536, 65536]


def test_columns_of_odd_rows(spark):
    table = rasters.drawn(1, None)
    colour = b"".join(bytes([v, v, v]) for v in table)
    rows = [(1, 240, 160, 1, table), (2, 240, 160, 3, colour), (3, 240, 160, 1, table[:-1]), (4, None, 1, 1, b"x"), (5, 1, 1, 1, None), (6, 3, 2, 1, b"\x00" * 6), (7, 0, 0, 1, b"")]
    x = spark.createDataFrame(rows, "id int, width int, height int, channels int, pixels binary")
    got = {r.id: r for r in raster.tables(x).collect()}
    assert got[1].rows == [10 + 24 * i for i in range(4)] and got[1].cols == [10, 60, 110, 160] and (got[1].cells, got[1].mean_width, got[1].mean_height) == (9, 50.0, 24.0)
    assert (got[2].rows, got[2].cols) == (got[1].rows, got[1].cols) and [got[i].rows for i in (3, 4, 5, 6, 7)] == [None, None, None, [], None] and {got[i].cells for i in (3, 4, 5, 6, 7)} == {0}
    p = x.select("id", raster.prepared(F.col("width"), F.col("height"), F.col("pixels"), " Grayscale ", F.col("channels")).alias("p"))
    assert {r.id: r.p and bytes(r.p) for r in p.collect()} == {1: table, 2: table, 3: None, 4: None, 5: None, 6: b"\x00" * 6, 7: None}
    assert raster.tables(x.where("false")).count() == 0
    with pytest.raises(ValueError, match="deskew"):
        raster.prepared(F.col("width"), F.col("height"), F.col("pixels"), ["clahe", "deskew"])
    assert raster.steps_of(["CLAHE", 3, "", None]) == ["clahe"] and raster.steps_of(None) == [] and raster.steps_of("") == []
