"""Exact top-k inner-product search by distributed histogram selection.

For a block of queries every candidate is scored in each round; tasks send histograms of the scores between two
edges per query, which are summed and narrow the edges around the k-th best score. The last round keeps what
reaches the k-th score, and of equal scores the smallest identifiers, at most k rows per query and task.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part; vectors of other
lengths are no candidates of a query; a query's own rows are those with its identifier; of several vectors with
one identifier the least is the query and each is a candidate; rows without identifier are no queries; ties go to the
smaller identifier; scores beyond a long stop at its limits, scaled components at 2**62; with fewer than k candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import common

BITS = 6
#: A histogram bin with so few rows is not refined further.
FEW = 16
CELLS = 1 << 21
#: Histograms take larger scores as this; the last round compares them whole.
EDGE = 1 << 61


def usable(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id long, v array<long>) with v = floor(scale * component), of the vectors that take part."""
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return vectors.where(fine).select(F.col("vec_id").cast("long"), F.transform("embedding", lambda x: F.least(F.greatest(F.floor(x.cast("double") * float(scale)), F.lit(-(2**62))), F.lit(2**62))).alias("v"))


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.int64).reshape(len(col), d)


def _scores(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer products, by floating point where that is exact."""
    most = float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0)) * c.shape[1]
    if most < 2**53:
        return (c.astype(np.float64) @ q.T.astype(np.float64)).astype(np.int64)
    if most < 2**62:
        return c @ q.T
    return np.clip(c.astype(object) @ q.T.astype(object), -(2**63) + 1, 2**63 - 1).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], ids: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(candidate ids, scores, True where the candidate is the query's own) in blocks of bounded size. ids ascend."""
    rows = max(1, CELLS // max(1, len(q)))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            b = batch.slice(at, rows)
            who = np.array(b.column(0).fill_null(0), np.int64)
            known = np.array(b.column(0).is_valid())
            own = np.zeros((len(who), len(q)), bool)
            k = np.minimum(np.searchsorted(ids, who), len(ids) - 1)
            hit = np.flatnonzero((ids[k] == who) & known)
            own[hit, k[hit]] = True
            yield np.where(known, who, np.iinfo(np.int64).max), _scores(_matrix(b.column(1), q.shape[1]), q), own


def _histograms(candidates: DataFrame, shipped, low: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Counts (query, bin) of the scores in [low, low + 2**(shift + BITS)) over all candidates."""
    edges = candidates.sparkSession.sparkContext.broadcast((low, shift))
    n, bins = len(low), 1 << BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ids, q), (lo, sh) = shipped.value, edges.value
        total = np.zeros(n * bins, np.int64)
        for _, s, own in _blocks(batches, ids, q):
            s = np.clip(s, -EDGE, EDGE)
            k = (s - lo) >> sh
            inside = (s >= lo) & (k < bins) & ~own
            total += np.bincount((np.arange(n) * bins + k)[inside], minlength=n * bins)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["cell", "n"])

    out = np.zeros(n * bins, np.int64)
    got = candidates.mapInArrow(common.lean(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out[np.array(got["cell"], np.int64)] = np.array(got["n"], np.int64)
    edges.destroy()
    return out.reshape(n, bins)


def _pass(candidates: DataFrame, ids: np.ndarray, q: np.ndarray, most: int, k: int) -> DataFrame:
    """The k best of all candidates for one block of queries."""
    shipped = candidates.sparkSession.sparkContext.broadcast((ids, q))
    reach = np.minimum(np.abs(q).astype(float).sum(1) * float(most) + 1, 2.0**61).astype(np.int64)
    low = -reach
    shift = np.maximum(np.ceil(np.log2((2 * reach + 1).astype(float) + 1)).astype(np.int64) - BITS, 0)
    missing = np.full(len(q), k, np.int64)
    open_ = np.ones(len(q), bool)
    while open_.any():
        h = _histograms(candidates, shipped, low, np.where(open_, shift, 0))
        above = np.cumsum(h[:, ::-1], axis=1)[:, ::-1]  # in this bin and higher ones
        # The highest bin that, with those above it, holds the rows still missing; bin 0 if there are too few rows.
        at = np.maximum((above >= missing[:, None]).sum(1) - 1, 0)
        row = np.arange(len(q))
        inside = h[row, at]
        higher = above[row, at] - inside
        low = np.where(open_, low + (at << shift), low)
        missing = np.where(open_, missing - higher, missing)
        open_ &= (shift > 0) & (inside > FEW) & (above[:, 0] >= missing)
        shift = np.where(open_, np.maximum(shift - BITS, 0), shift)
    floor = candidates.sparkSession.sparkContext.broadcast(low)

    def best(x: np.ndarray) -> np.ndarray:
        x = x[np.lexsort((x[:, 1], -x[:, 2], x[:, 0]))]
        first = np.flatnonzero(np.append(True, x[1:, 0] != x[:-1, 0])) if len(x) else np.zeros(0, int)
        return x[np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x)))) < k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (qid, qv), lo = shipped.value, floor.value
        held = np.zeros((0, 3), np.int64)
        for who, s, own in _blocks(batches, qid, qv):
            r, c = np.nonzero((np.clip(s, -EDGE, EDGE) >= lo) & ~own)
            held = best(np.concatenate([held, np.stack([qid[c], who[r], s[r, c]], axis=1)]))
        yield pa.RecordBatch.from_arrays([pa.array(held[:, i], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

    return candidates.mapInArrow(common.lean(run), "query_id long, vec_id long, score long")


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, block: int = 2048) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best rows of vectors (vec_id, embedding) for each row where is_query holds.

    Queries are taken in blocks of `block`, by length and identifier, each a pass over all candidates; a block is what is
    broadcast, so its size does not depend on the data."""
    spark = vectors.sparkSession
    rows = common.materialize(usable(vectors, scale).withColumn("d", F.size("v")), "vectors")  # every round reads them
    queries = rows.where(is_query & F.col("vec_id").isNotNull())
    sizes = queries.select("d").distinct().toArrow()["d"].to_pylist()
    parts: list[DataFrame] = []
    for d in sorted(sizes):
        candidates = rows.where(F.col("d") == d).select("vec_id", "v")
        most = candidates.agg(F.max(F.greatest(F.abs(F.coalesce(F.array_max("v"), F.lit(0))), F.abs(F.coalesce(F.array_min("v"), F.lit(0)))))).first()[0] or 0
        last: int | None = None
        while True:
            rest = queries.where(F.col("d") == d)
            rest = rest.where(F.col("vec_id") > last) if last is not None else rest
            got = rest.groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").limit(block).toArrow()
            if not got.num_rows:
                break
            ids, q = np.array(got["vec_id"], np.int64), _matrix(got["v"].combine_chunks(), d)
            last = int(ids[-1])
            parts.append(_pass(candidates, ids, q, most, k))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), F.when(F.col("vec_id") != 2**63 - 1, F.col("vec_id")).alias("vec_id"), "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
