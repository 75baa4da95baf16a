"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees over binned features are boosted cyclically, feature by feature, then pair by pair; all they learn
is added into one lookup table per feature and per pair. A text's score is the sigmoid of the sum of its bins.

Defined results: null and empty texts get the features of an empty text, hence a score as well; without labels, or with
labels of one kind only, the score is the share of that label (0.5 without any); equal texts have equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import common

FEATURES = (
    "log_bytes", "log_words", "word_length", "upper", "digit", "stop", "symbol", "space", "wide", "newline", "distinct", "repeated", "commonest",
    "no_letter", "odd_end", "sentence", "long_word",
)
STOPS, NEWLINE = b".,;:!?'\"-()", 0x0A


def _classes() -> dict[str, np.ndarray]:
    c = np.arange(256)
    upper, lower, digit = (c >= 65) & (c <= 90), (c >= 97) & (c <= 122), (c >= 48) & (c <= 57)
    stop, space, wide = np.isin(c, list(STOPS)), np.isin(c, [32, *range(9, 14)]), c >= 128
    return {"upper": upper, "digit": digit, "stop": stop, "symbol": ~(upper | lower | digit | stop | space | wide), "space": space, "wide": wide, "newline": c == NEWLINE, "letter": upper | lower | wide, "end": np.isin(c, list(b".!?"))}


def features(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each document raw[off[i]:off[i+1]], by whole-array counts."""
    n, size = len(off) - 1, np.diff(off)
    cls = _classes()
    some = size > 0

    def per_doc(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        if some.any():
            out[some] = np.add.reduceat(mask[raw], off[:-1][some], dtype=np.int64)
        return out

    count = {k: per_doc(m) for k, m in cls.items()}
    start, end, doc, h = common.words_of(raw, off)
    words = np.bincount(doc, minlength=n).astype(float)
    length = (end - start).astype(float)
    sum_of = lambda x: np.bincount(doc, weights=x, minlength=n)
    letters = np.zeros(len(start))
    if len(start):
        # Letters before each word's start and end, from running totals.
        total = np.append(0, np.cumsum(cls["letter"][raw]))
        letters = (total[end] - total[start]).astype(float)
    same = np.append(False, (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])) if len(h) else np.zeros(0, bool)
    order = np.lexsort((h, doc))
    hs, ds = h[order], doc[order]
    new = np.append(True, (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])) if len(hs) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(hs)))
    commonest = np.zeros(n)
    np.maximum.at(commonest, ds[at], runs)
    odd = ~(cls["letter"] | cls["digit"] | np.isin(np.arange(256), list(b".,;:!?")))[raw[end - 1]] if len(end) else np.zeros(0)
    by, w = np.maximum(size, 1), np.maximum(words, 1)
    cols = {
        "log_bytes": np.log1p(size), "log_words": np.log1p(words), "word_length": sum_of(length) / w, **{k: count[k] / by for k in ("upper", "digit", "stop", "symbol", "space", "wide", "newline")},
        "distinct": np.bincount(ds[at], minlength=n) / w, "repeated": sum_of(same.astype(float)) / w, "commonest": commonest / w, "no_letter": sum_of((letters == 0).astype(float)) / w,
        "odd_end": sum_of(odd.astype(float)) / w, "sentence": words / (count["end"] + 1), "long_word": sum_of((length > 20).astype(float)) / w,
    }
    return np.stack([cols[k] for k in FEATURES], axis=1)


def _tree(grad: np.ndarray, hess: np.ndarray, splits: int, ridge: float) -> np.ndarray:
    """The values of a tree with up to `splits` splits over ordered bins."""
    leaves = [(0, len(grad))]
    g, h = np.append(0, np.cumsum(grad)), np.append(0, np.cumsum(hess))
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    for _ in range(splits):
        best = (1e-9, None, 0)
        for leaf in leaves:
            a, b = leaf
            if b - a > 1:
                mid = np.arange(a + 1, b)
                won = gain(a, mid) + gain(mid, b) - gain(a, b)
                k = int(np.argmax(won))
                if won[k] > best[0]:
                    best = (float(won[k]), leaf, int(mid[k]))
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(grad))
    for a, b in leaves:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out


class Additive:
    """base + table of each feature's bin + table of each pair's coarse bins."""

    def __init__(self, bins: int = 64, coarse: int = 8, rounds: int = 120, pairs: int = 6, pair_rounds: int = 40, rate: float = 0.15, ridge: float = 2.0):
        self.bins, self.coarse, self.rounds, self.n_pairs, self.pair_rounds, self.rate, self.ridge = bins, coarse, rounds, pairs, pair_rounds, rate, ridge

    def _bin(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)])

    def fit(self, x: np.ndarray, y: np.ndarray) -> Additive:
        share = float(y.mean()) if len(y) else 0.5
        self.edges = self.wide = []
        self.tables, self.pairs = [], []
        if share in (0.0, 1.0) or not len(y):
            self.base = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
            return self
        cut = lambda n: [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n + 1)[1:-1])) for j in range(x.shape[1])]
        self.edges, self.wide = cut(self.bins), cut(self.coarse)
        self.base = float(np.log(share / (1 - share)))
        b, c = self._bin(x, self.edges), self._bin(x, self.wide)
        f = np.full(len(y), self.base)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]

        def step(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-f))
            return np.bincount(index, y - p, size), np.bincount(index, p * (1 - p), size)

        for _ in range(self.rounds):
            for j, t in enumerate(self.tables):
                add = self.rate * _tree(*step(b[j], len(t)), splits=2, ridge=self.ridge)
                t += add
                f += add[b[j]]
        # Pairs by how much of the rest a full table of coarse bins could explain.
        rest = []
        for i in range(len(self.wide)):
            for j in range(i):
                index, size = c[i] * (len(self.wide[j]) + 1) + c[j], (len(self.wide[i]) + 1) * (len(self.wide[j]) + 1)
                g, h = step(index, size)
                rest.append((float((g**2 / (h + self.ridge)).sum()), i, j))
        self.pairs = [(i, j, np.zeros((len(self.wide[i]) + 1) * (len(self.wide[j]) + 1))) for _, i, j in sorted(rest, reverse=True)[: self.n_pairs]]
        for _ in range(self.pair_rounds):
            for i, j, t in self.pairs:
                k = len(self.wide[j]) + 1
                index = c[i] * k + c[j]
                g, h = (z.reshape(-1, k) for z in step(index, len(t)))
                # A shallow tree: one split of the first feature, then one of the second on each side.
                side = _tree(g.sum(1), h.sum(1), splits=1, ridge=self.ridge)
                add = np.zeros_like(g)
                for v in np.unique(side):
                    rows = side == v
                    add[rows] = _tree(g[rows].sum(0), h[rows].sum(0), splits=1, ridge=self.ridge)
                add = self.rate * add.ravel()
                t += add
                f += add[index]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        if len(x) and self.tables:
            b, c = self._bin(x, self.edges), self._bin(x, self.wide)
            for j, t in enumerate(self.tables):
                f += t[b[j]]
            for i, j, t in self.pairs:
                f += t[c[i] * (len(self.wide[j]) + 1) + c[j]]
        return 1 / (1 + np.exp(-f))


def _featured(docs: DataFrame, text: str) -> DataFrame:
    names = ["doc_id", "__y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in common.slices(whole, "__text"):
                x = features(*common.flat_bytes(b.column(2)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=[*names, "x"])

    return docs.select("doc_id", "__y", F.col(text).alias("__text")).mapInArrow(common.lean(run), "doc_id long, __y int, x array<double>")


def train(docs: DataFrame, labelled: DataFrame, label: str = "quality", text: str = "text", rows: int = 20_000) -> Additive:
    """Fit on the texts of labelled (doc_id, label) rows: the `rows` documents of least hash, a bounded sample.

    The larger of several labels of a document counts; of repeated documents one is taken."""
    y = labelled.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("__y"))
    few = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    some = docs.select(F.col("doc_id").cast("long"), text).join(F.broadcast(few), "doc_id")
    got = _featured(some, text).groupBy("doc_id").agg(F.min(F.struct("x", "__y")).alias("s")).select("s.*").toArrow()
    x = np.array(got["x"].combine_chunks().flatten() if got.num_rows else [], float).reshape(got.num_rows, len(FEATURES))
    order = np.lexsort(x.T) if len(x) else np.zeros(0, int)
    return Additive().fit(x[order], np.array(got["__y"], float)[order])


def score(docs: DataFrame, model: Additive, text: str = "text", to: str = "score") -> DataFrame:
    """docs with the column `to`: the score of each whole text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        common.settle()
        for whole in batches:
            out = [np.zeros(0)]
            for b in common.slices(pa.RecordBatch.from_arrays([whole], names=["t"]), "t"):
                out.append(shipped.value.score(features(*common.flat_bytes(b.column(0)))))
            yield pa.array(np.concatenate(out), pa.float64())
        common.trim()

    return docs.withColumn(to, run(F.coalesce(F.col(text), F.lit(""))))
