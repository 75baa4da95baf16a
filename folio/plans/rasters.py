"""Queries of pictures that are drawn from the vectors of a whole table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from folio.operators import raster
from folio.plans.registry import query
from folio.plans.views import table

WIDTH, HEIGHT = 240, 160


def drawn(number: int, vector: list | None) -> bytes:
    """A table of 3 to 6 lines across and 3 to 5 down, three places thick, with a dot by the size of each component (none for null)."""
    x = np.full((HEIGHT, WIDTH), 250, np.uint8)
    rows, cols = 3 + number % 4, 3 + number % 3
    for i in range(rows):
        x[9 + 24 * i : 12 + 24 * i, 9 : 12 + 50 * (cols - 1)] = 0
    for j in range(cols):
        x[9 : 12 + 24 * (rows - 1), 9 + 50 * j : 12 + 50 * j] = 0
    for i, v in enumerate(vector or []):
        if v is not None and np.isfinite(v):
            at = int(abs(v) * 4096) * 31 + i * 977
            x[8 + at // 7 % (HEIGHT - 16) // 4 * 4, 4 + at % (WIDTH - 8) // 8 * 8] = 0
    return x.tobytes()


def shaded(vector: list | None) -> bytes:
    """A square whose brightness is the sum of two components, one for the row and one for the place in it (null and not finite: 0)."""
    v = np.array([0 if c is None or not np.isfinite(c) else int(max(-512, min(512, np.floor(c * 256)))) for c in vector or [0]], np.int64)
    return np.clip(128 + v[:, None] + v[None, :], 0, 255).astype(np.uint8).tobytes()


@query("""WITH v AS (SELECT vec_id, 3 + vec_id % 4 AS r, 3 + vec_id % 3 AS c FROM embeddings)
SELECT vec_id, array_to_string(list_transform(range(r), lambda i: 10 + 24 * i), ',') AS rows_at, array_to_string(list_transform(range(c), lambda i: 10 + 50 * i), ',') AS cols_at, ((r - 1) * (c - 1))::INT AS cells, 50.0::DOUBLE AS mean_width, 24.0::DOUBLE AS mean_height FROM v""")
def pixel_grids(spark, d):
    """Tables drawn from all vectors, with dots that are no lines, found again in the pixels."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for n, v in batches:
            yield pa.array([drawn(a, b) for a, b in zip(n.to_pylist(), v.to_pylist())], pa.binary())

    x = table(spark, d, "embeddings").select("vec_id", F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"), run(F.col("vec_id"), F.col("embedding")).alias("pixels"))
    said = lambda c: F.array_join(F.transform(c, lambda p: p.cast("string")), ",")
    return raster.tables(x).select("vec_id", said("rows").alias("rows_at"), said("cols").alias("cols_at"), "cells", "mean_width", "mean_height")


@query()
def raster_steps(spark, d):
    """Squares shaded by all vectors after contrast, sharpening and threshold, as digests; tests compare with a plain version."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in batches:
            yield pa.array([shaded(b) for b in v.to_pylist()], pa.binary())

    side = F.greatest(F.coalesce(F.size("embedding"), F.lit(0)), F.lit(1))
    x = table(spark, d, "embeddings").select("vec_id", side.alias("side"), run(F.col("embedding")).alias("pixels"))
    step = lambda *names: F.sha2(raster.prepared(F.col("side"), F.col("side"), F.col("pixels"), list(names)), 256)
    return x.select("vec_id", step("clahe").alias("clahe"), step("unsharp").alias("unsharp"), step("adaptive").alias("adaptive"), step("clahe", "unsharp", "adaptive").alias("all_three"))
