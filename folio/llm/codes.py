"""Product codes of vectors: a codebook for each of their parts by Lloyd rounds in whole numbers, kept cheap by Yinyang bounds.

Components become floor(scale * x); vectors are cut into equal parts, the codebook of each starts with the vectors of the least identifiers. In a
round every part goes to its nearest entry (ties: the lower index), then entries become the floors of their parts' means.

The entries of a codebook are clustered into groups once. For every part of a vector the table of the state holds the entry it is at and, per group, a
lower bound of its distance to the group's other entries. After a round the bound falls by the largest drift in its group; only groups whose bound does not exceed the
(recomputed) distance to the part's own entry are scanned. Bounds are floating-point with a margin; whatever is scanned is decided in whole numbers, so ties and results are exact.

Each round is one pass of Spark tasks over the state, written to the shared folder with the tasks' sums beside it; the driver handles sums and codebooks only,
whose size depends on neither rows nor tasks once they are added up.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part; each length of vectors has codebooks of its own,
and lengths that the parts don't divide are filled up with zeros; of rows with one identifier that with the smaller vector is first in the choice of entries, null
identifiers are last; with fewer rows than entries the codebook is smaller; components beyond 2**52 stop there, sums of errors at the limits of a long; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import common

SCALE, PARTS, ENTRIES, ROUNDS, GROUPS = 4096, 8, 16, 6, 4
#: Beyond this size of components distances are computed in Python's whole numbers.
EXACT = 1 << 26
LONG = 2**63 - 1
STATE = "vec_id long, label int, v binary, at binary, low binary, part int, entry int, n long, sums array<decimal(38,0)>"
ROWS = 1 << 13


def whole(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v array<long>, d) of the vectors that take part."""
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    v = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(x.cast("double") * float(scale), F.lit(-(2.0**52))), F.lit(2.0**52))).cast("long"))
    return vectors.where(fine).select(F.col("vec_id").cast("long"), F.col("label").cast("int"), v.alias("v")).withColumn("d", F.size("v"))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances over the last axis, as whole numbers."""
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) > EXACT:
        x, y = x.astype(object), y.astype(object)
    d = x - y
    return (d * d).sum(-1)


def grouped(codebook: np.ndarray, groups: int) -> np.ndarray:
    """The group of each entry: a few Lloyd rounds over the entries themselves."""
    e = codebook.astype(float)
    centres = e[np.linspace(0, len(e) - 1, min(groups, len(e))).astype(int)]
    of = np.zeros(len(e), int)
    for _ in range(5):
        of = ((e[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        centres = np.stack([e[of == g].mean(0) if (of == g).any() else centres[g] for g in range(len(centres))])
    return np.unique(of, return_inverse=True)[1]


def root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(float))


def assign(x: np.ndarray, at: np.ndarray, low: np.ndarray, book: np.ndarray, of: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry, lower bounds, squared distance, scanned pairs) of the vectors x of one part, which were at `at` with the bounds `low` before book moved by drift."""
    n_groups = low.shape[1]
    fall = np.array([drift[of == g].max(initial=0) for g in range(n_groups)])
    low = low - fall
    best, near = at.copy(), squared(x, book[at])
    own = root(near)
    first, mine = near.copy(), of[at]
    margin = 1e-9 * (own[:, None] + np.where(np.isfinite(low), np.abs(low), 0) + fall + 1)
    open_ = low - margin <= own[:, None]
    scanned = 0
    found = []
    for g in range(n_groups):
        rows, members = np.flatnonzero(open_[:, g]), np.flatnonzero(of == g)
        if not len(rows) or not len(members):
            continue
        scanned += len(rows) * len(members)
        d = squared(x[rows, None], book[members][None])
        k = d.argmin(1)  # of equals the first, which has the lower index
        least = d[np.arange(len(rows)), k]
        better = (least < near[rows]) | ((least == near[rows]) & (members[k] < best[rows]))
        best[rows] = np.where(better, members[k], best[rows])
        near[rows] = np.where(better, least, near[rows])
        found.append((g, rows, members, d))
    for g, rows, members, d in found:
        r = root(d)
        r[members[None] == best[rows][:, None]] = np.inf
        low[rows, g] = r.min(1)
    # An entry that was left counts from now on among the others of its group.
    moved = np.flatnonzero(best != at)
    low[moved, mine[moved]] = np.minimum(low[moved, mine[moved]], root(first[moved]))
    return best, low, near, scanned


def _matrix(col: pa.Array, kind, shape: tuple[int, ...]) -> np.ndarray:
    raw, _ = common.flat_bytes(col)
    return raw.view(kind).reshape(len(col), *shape)


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())


def _round(state: DataFrame, books: np.ndarray, of: np.ndarray, drift: np.ndarray, schema: str, last: bool = False) -> DataFrame:
    """A pass: every part at its nearest entry, and rows of sums per task. With `last`: (vec_id, label, code, error)."""
    shipped = state.sparkSession.sparkContext.broadcast((books, of, drift))
    parts, entries, width = books.shape
    n_groups = int(of.max(initial=0)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, groups, moved = shipped.value
        sums, count = np.zeros((parts, entries, width), object), np.zeros((parts, entries), np.int64)
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, ROWS):
                b = whole_batch.slice(start, ROWS)
                x = _matrix(b.column(2), np.int64, (parts, width))
                at = _matrix(b.column(3), np.uint8, (parts,)).astype(np.int64)
                low = _matrix(b.column(4), np.float32, (parts, n_groups)).astype(float)
                error = np.zeros(len(x), object)
                for p in range(parts):
                    at[:, p], low[:, p], near, _ = assign(x[:, p], at[:, p], low[:, p], book[p], groups[p], moved[p])
                    error += near.astype(object)
                    if not last:
                        for e in np.unique(at[:, p]):
                            own = x[at[:, p] == e, p]
                            sums[p, e] += own.sum(0) if np.abs(own).max(initial=0) < EXACT else own.astype(object).sum(0)
                            count[p, e] += len(own)
                if last:
                    code = ["".join(f"{i:02x}" for i in r) for r in at]
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(code, pa.string()), pa.array([min(int(e), LONG) for e in error], pa.int64())], names=["vec_id", "label", "code", "error"])
                else:
                    bound = np.nextafter(low.astype(np.float32), np.float32(-np.inf))
                    yield rows_of(b.column(0), b.column(1), b.column(2), _packed(at.astype(np.uint8)), _packed(bound))
        if not last:
            used = np.argwhere(count)
            n = len(used)
            none = lambda kind: pa.nulls(n, kind)
            numbers = [[int(s) for s in sums[p, e]] for p, e in used]
            yield pa.RecordBatch.from_arrays(
                [none(pa.int64()), none(pa.int32()), none(pa.binary()), none(pa.binary()), none(pa.binary()), pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array(count[tuple(used.T)], pa.int64()), decimals(numbers)], names=NAMES
            )

    return state.mapInArrow(common.lean(run), schema)


NAMES = [x.split()[0] for x in STATE.split(", ")]


def decimals(rows: list[list[int]]) -> pa.Array:
    from decimal import Decimal

    return pa.array([[Decimal(x) for x in r] for r in rows], pa.list_(pa.decimal128(38, 0)))


def rows_of(vec_id, label, v, at, low) -> pa.RecordBatch:
    n = len(vec_id)
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0)))
    return pa.RecordBatch.from_arrays([vec_id, label, v, at, low, *[pa.nulls(n, k) for k in kinds]], names=NAMES)


def _start(rows: DataFrame, parts: int, width: int, groups: int) -> DataFrame:
    """The state before the first round: at entry 0, with bounds that let nothing be skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            d = len(b.column(2)[0])
            v = np.zeros((b.num_rows, parts * width), np.int64)
            v[:, :d] = np.asarray(b.column(2).flatten(), np.int64).reshape(b.num_rows, d)
            yield rows_of(b.column(0), b.column(1), _packed(v), _packed(np.zeros((b.num_rows, parts), np.uint8)), _packed(np.zeros((b.num_rows, parts * groups), np.float32)))

    return rows.select("vec_id", "label", "v").mapInArrow(common.lean(run), STATE)


def _books(rows: DataFrame, parts: int, entries: int, width: int) -> np.ndarray:
    """(parts, entries, width): the parts of the first vectors."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # at most `entries` rows
    v = np.zeros((len(first), parts * width), np.int64)
    for i, r in enumerate(first):
        v[i, : len(r.v)] = r.v
    return v.reshape(len(first), parts, width).transpose(1, 0, 2).copy()


def _moved(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The books after a round, from the sums of the state's tasks."""
    width = books.shape[2]
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    new = books.copy()
    for r in state.where("part is not null").groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():  # parts x entries rows at most
        new[r.part, r.entry] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return new


def _coded(rows: DataFrame, d: int, parts: int, entries: int, rounds: int, groups: int) -> DataFrame:
    width = -(-d // parts)
    books = _books(rows, parts, entries, width)
    of = np.stack([grouped(b, groups) for b in books])
    n_groups = int(of.max(initial=0)) + 1
    drift = np.zeros(books.shape[:2])
    state = common.materialize(_start(rows, parts, width, n_groups), "codes")
    for _ in range(rounds):
        state = common.materialize(_round(state.where("part is null"), books, of, drift, STATE), "codes")
        new = _moved(state, books)
        drift = root(squared(new, books)) * (1 + 1e-12)
        books = new
    name = hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()
    coded = _round(state.where("part is null"), books, of, drift, "vec_id long, label int, code string, error long", last=True)
    return coded.withColumn("codebooks_sha256", F.lit(name))


def compress(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, groups: int = GROUPS) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of vectors (vec_id, embedding, label)."""
    if not 1 <= entries <= 256:
        raise ValueError("entries: 1 to 256, which two hex digits hold")
    rows = common.materialize(whole(vectors, scale), "vectors")
    sizes = [r.d for r in rows.select("d").distinct().collect()]  # lengths of vectors
    coded = [_coded(rows.where(F.col("d") == d), d, parts, entries, rounds, groups) for d in sorted(sizes)]
    if not coded:
        return vectors.sparkSession.createDataFrame([], "vec_id long, label int, code string, error long, label_error long, codebooks_sha256 string")
    out = common.materialize(reduce(DataFrame.unionByName, coded), "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    sums = out.groupBy("label").agg(total.alias("label_error"))
    none = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(LONG))
    sums = common.materialize(sums.select(none("label").alias("__label"), "label_error"), "label-errors")
    few = sums.count() <= 1_000_000
    x = out.withColumn("__label", none("label")).join(F.broadcast(sums) if few else sums, "__label")
    return x.select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")


def oracle(parts: int = 8, width: int = 8) -> str:
    """The rounds one after another, for vectors of parts * width components."""
    sql = f"""WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, p::INTEGER AS p, list_slice(v, p * {width} + 1, (p + 1) * {width}) AS x FROM v, range({parts}) r(p)),
c0 AS MATERIALIZED (SELECT p, (row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1)::INTEGER AS e, x AS c FROM x QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {ENTRIES})"""
    for r in range(ROUNDS + 1):
        sql += f""",
d{r} AS (SELECT x.vec_id, x.p, x.x, e, list_sum(list_transform(list_zip(x.x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM x JOIN c{r} USING (p)),
a{r} AS MATERIALIZED (SELECT vec_id, p, any_value(x) AS x, (min(d * {ENTRIES} + e) % {ENTRIES})::INTEGER AS e, min(d) AS d FROM d{r} GROUP BY vec_id, p)"""
        if r < ROUNDS:
            sql += f""",
u{r} AS (SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, {width + 1}) q(i) GROUP BY p, e, i),
m{r} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM u{r} GROUP BY p, e),
c{r + 1} AS MATERIALIZED (SELECT c{r}.p, c{r}.e, coalesce(m, c) AS c FROM c{r} LEFT JOIN m{r} USING (p, e))"""
    return f"""{sql},
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM c{ROUNDS}),
o AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, label, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM o JOIN v USING (vec_id), s"""
