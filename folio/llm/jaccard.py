"""N-gram Jaccard join by universe partition and the pigeonhole principle.

A document's set holds the hashes of its distinct word shingles; documents of one set are one node. For sets of a size band, two sets above
the threshold differ in at most H elements. The universe of hashes is cut into H + 1 + S segments, so they agree in at least S + 1: each
non-empty segment subset is indexed. An empty segment is worthless (very many sets agree in it) and is left out. Two sets with at most S empty
segments in common still agree in another. A set that has E > S empty segments also indexes the one-deletion neighbourhoods of the next T
segments after each, with T = E plus its segments of one element or none: if two sets agree in empty segments only, at most E - S - 1 of the
others can differ in two or more elements, and among the T after a common empty one at least E are neither empty in both nor one element
against none, hence one of them differs by exactly one element and is found through the larger side's deletions. Where segments are too
few for that, empty ones are indexed as well. Allocation by cost: S is chosen per band so that the entries expected for a set are fewest.

Candidates of a bucket are verified exactly, on recomputed sets, but only until the bucket is one component: first all members against one of
them, then what is left between components. A parity bitmap (each element flips one bit of as many as the set has elements, SKETCH at least, so bitmaps differ in no more bits than
sets in elements) drops pairs safely. No step lists all pairs of a bucket; very frequent buckets are spread and compared in blocks.

Defined results: words are `[^\\x20\\x09-\\x0D]+` with A-Z lowered; a document with fewer words than a shingle has one element, its whole
sequence; null, empty and blank texts have none and are linked with nothing; repeated rows are nodes once and each get their row; null
identifiers are never a component's name unless there is no other; sets and their elements are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import common
from folio.llm.components import components

U = np.uint64
GROWTH = 1.3
#: A key of so many sets in a slice of texts, in a task, or in all, is spread.
HOT_HERE, HOT_TASK, HOT_ALL = 256, 1_024, 50_000
#: Cells of the sketch of a task's keys.
CELLS = 1 << 21
SKETCH = 512
PART = 64
BLOCK = 4096
BEST = 4
PLAIN, SPREAD, MARK, DOC = range(4)


# ---- sets


def shingle_sets(raw: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, borders): the sorted distinct shingle hashes of each document, one after the other."""
    _, _, doc, h = common.words_of(raw, off)
    docs = len(off) - 1
    words = np.bincount(doc, minlength=docs)
    begin = np.cumsum(words) - words
    # A shingle at each word that has n - 1 followers in its document; short documents: one of all their words.
    left = (begin + words)[doc] - np.arange(len(h)) if len(h) else np.zeros(0, np.int64)
    size = np.minimum(words[doc], n) if len(h) else left
    at = np.flatnonzero(left >= size)
    at = at[(words[doc[at]] >= n) | (at == begin[doc[at]])]
    s = np.zeros(len(at), U)
    for i in range(n):
        more = size[at] > i
        part = s[more]
        s[more] = common.mix(part * U(0x9FB21C651E98DF25) + h[at[more] + i] + U(i + 1))
    d = doc[at]
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    new = np.append(True, (s[1:] != s[:-1]) | (d[1:] != d[:-1])) if len(s) else np.zeros(0, bool)
    s, d = s[new], d[new]
    return s, np.append(0, np.cumsum(np.bincount(d, minlength=docs)))


def set_names(s: np.ndarray, border: np.ndarray) -> np.ndarray:
    """A hash of each set as a signed long."""
    total = np.append(U(0), np.cumsum(common.mix(s ^ U(0xA5A5A5A5A5A5A5A5))))
    return common.mix(total[border[1:]] - total[border[:-1]] + common.mix(np.diff(border).astype(U))).view(np.int64)


def most_different(a: int, b: int, num: int, den: int) -> int:
    """The most elements in which sets of a and b elements with Jaccard >= num / den differ."""
    return (den - num) * (a + b) // (den + num)


@lru_cache(maxsize=8)
def bands(num: int, den: int, most: int = 1 << 31) -> list[tuple[int, int, int, int]]:
    """(least size, largest size, segments, S) of each band of sizes."""
    out, lo = [], 1
    while lo < most:
        hi = max(lo + 1, int(lo * GROWTH)) - 1
        h, n = most_different(hi, hi * den // num, num, den), math.sqrt(lo * hi)
        spare = min(range(41), key=lambda s: h + 1 + s + n * _more_than(s, (h + 1 + s) * math.exp(-n / (h + 1 + s)))) if h else 0
        out.append((lo, hi, h + 1 + spare, spare))
        lo = hi + 1
    return out


def _more_than(k: int, mean: float) -> float:
    """The chance that a Poisson number exceeds k."""
    if mean > 600:
        return 1.0
    term = total = math.exp(-mean)
    for i in range(1, k + 1):
        term *= mean / i
        total += term
    return max(0.0, 1.0 - total)


@lru_cache(maxsize=256)
def _edges(m: int) -> np.ndarray:
    return np.array([-(-(i << 64) // m) for i in range(1, m)], U)


def signatures(s: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, bool]]:
    """(bucket keys, True if the set's size lies in the band) for each band in which the set, sorted, can have a partner of its size or less."""
    n = len(s)
    weight = common.mix(s + U(0x5851F42D4C957F2D))
    total = np.append(U(0), np.cumsum(weight))
    least = -(-n * num // den)
    for b, (lo, hi, m, spare) in enumerate(bands(num, den)):
        if hi < least:
            continue
        if lo > n:
            break
        cut = np.concatenate([[0], np.searchsorted(s, _edges(m)), [n]])
        size = np.diff(cut)
        tag = common.mix(np.arange(m, dtype=U) + U(b << 32))
        sums = total[cut[1:]] - total[cut[:-1]]
        keys = [common.mix(sums + tag)[size > 0]]
        if len(empty := np.flatnonzero(size == 0)) > spare:
            reach = len(empty) + int((size <= 1).sum())
            if reach + 1 > m:
                keys.append(common.mix(tag[empty]))
                seg = np.arange(m)
            else:
                seg = np.unique((empty[:, None] + 1 + np.arange(reach)) % m)
            seg = seg[size[seg] > 1]
            at = np.concatenate([np.arange(cut[i], cut[i + 1]) for i in seg]) if len(seg) else np.zeros(0, np.int64)
            of = np.repeat(seg, size[seg])
            keys.append(common.mix(sums[of] - weight[at] + tag[of]))
        yield np.concatenate(keys), lo <= n <= hi


def bitmaps(s: np.ndarray, border: np.ndarray) -> pa.Array:
    """The parity bitmap of each set as longs: a power of two of bits, as many as elements and SKETCH at least. Halves put together by xor give the smaller ones."""
    size = np.diff(border)
    wide = np.maximum(1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64), SKETCH)
    off = np.append(0, np.cumsum(wide))
    doc = np.repeat(np.arange(len(size)), size)
    bits = np.bincount(off[doc] + ((s >> U(20)) & (wide[doc] - 1).astype(U)).astype(np.int64), minlength=off[-1]) & 1
    longs = np.packbits(bits.astype(np.uint8)).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(off // 64, pa.int32()), pa.array(longs))


def folded(bits: str, longs: str) -> str:
    """SQL: a bitmap folded to so many longs."""
    return f"if(size({bits}) = {longs}, {bits}, transform(sequence(0, {longs} - 1), i -> aggregate(sequence(i, size({bits}) - 1, {longs}), 0L, (t, j) -> t ^ {bits}[j])))"


def few_bits_differ(num: int, den: int) -> str:
    """SQL: whether the bitmaps of the sets x and y (n, bits) allow them to be linked."""
    x, y = (folded(c, "least(size(x.bits), size(y.bits))") for c in ("x.bits", "y.bits"))
    return f"aggregate(zip_with({x}, {y}, (p, q) -> bit_count(p ^ q)), 0, (t, v) -> t + v) <= {den - num} * (x.n + y.n) div {den + num}"


# ---- the distributed parts


def _buckets(docs: DataFrame, n: int, num: int, den: int, text: str) -> DataFrame:
    """Bucket entries and document rows of one pass over the texts.

    Entries: key, s (name of the set), size (2 * size + 1 if in the band), kind PLAIN, SPREAD (a frequent key, dealt out by s, its true value in
    `of`) or MARK (of a frequent key, for the others). Documents: kind DOC, s, size (of the set), of (doc_id, null kept), th (hash of the text), bits."""
    names = ["key", "s", "size", "kind", "of", "th", "bits"]
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sketch = np.zeros(CELLS, np.int32)
        for whole in batches:
            for b in common.slices(whole, "t", 1 << 20):
                sets, border = shingle_sets(*common.flat_bytes(b.column(2)), n)
                sizes, own_names = np.diff(border), set_names(sets, border)
                th = np.array(b.column(1), np.int64)
                spread = common.mix(th.view(U) ^ np.arange(len(th)).astype(U)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(own_names), pa.array(sizes.astype(np.int32)), pa.array(np.full(len(th), DOC, np.int32)), b.column(0), b.column(1), bitmaps(sets, border)], names=names)
                keys, who, size = [], [], []
                for i, name in enumerate(own_names.tolist()):
                    if not sizes[i] or name in seen:
                        continue
                    seen.add(name)
                    for got, own in signatures(sets[border[i] : border[i + 1]], num, den):
                        keys.append(got)
                        who.append(np.full(len(got), name))
                        size.append(np.full(len(got), 2 * sizes[i] + own, np.int32))
                if not keys:
                    continue
                key, s, z = np.concatenate(keys), np.concatenate(who), np.concatenate(size)
                uniq, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
                cell = ((uniq >> U(20)) % U(CELLS)).astype(np.int64)
                np.add.at(sketch, cell, count.astype(np.int32))
                often = (count >= HOT_HERE) | (sketch[cell] >= HOT_TASK)
                hot, marks = often[inverse], uniq[often]
                pad = np.zeros(len(marks), np.int32)
                spread = np.where(hot, common.mix(key + s.view(U)), key)
                cols = [
                    np.append(spread, marks).view(np.int64), np.append(s, pad), np.append(z, pad), np.append(np.where(hot, SPREAD, PLAIN), pad + MARK).astype(np.int32),
                    np.append(np.where(hot, key, U(0)), marks).view(np.int64), np.zeros(len(key) + len(marks), np.int64),
                ]
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in cols], pa.nulls(len(cols[0]), longs)], names=names)

    t = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("th"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    return t.mapInArrow(common.lean(run), "key long, s long, size int, kind int, of long, th long, bits array<long>")


def _gathered(buckets: DataFrame) -> DataFrame:
    """(g, s, size, doc, doc_id, th, bits): the members of each bucket of two sets or more, one in the band at least (equal member lists are one bucket to a
    task), and the document rows as they came."""
    names = ["g", "s", "size", "doc", "doc_id", "th", "bits"]

    def judge(x: list[np.ndarray], known: set[int]) -> pa.RecordBatch | None:
        key, s, size, kind, of = x
        a0 = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        per = np.diff(np.append(a0, len(key)))
        marked = np.repeat(np.maximum.reduceat((kind == MARK).astype(np.int8), a0) > 0, per)
        plain = kind == PLAIN
        twice = np.append(False, (key[1:] == key[:-1]) & (s[1:] == s[:-1]) & plain[1:] & plain[:-1])
        plain &= ~twice
        fine = (np.add.reduceat(plain.astype(np.int64), a0) > 1) & (np.maximum.reduceat(np.where(plain, size & 1, 0), a0) > 0)
        name = common.mix(np.add.reduceat(np.where(plain, common.mix(s.view(U) * U(2) + (size & 1).astype(U)), U(0)), a0)).view(np.int64)
        fresh = fine.copy()
        at = np.flatnonzero(fine)
        fresh[at] = [g not in known and not known.add(g) for g in name[at].tolist()]
        if len(known) > 1_000_000:
            known.clear()
        take = (np.repeat(fresh, per) & plain & ~marked) | (marked & plain) | (kind == SPREAD)
        if not take.any():
            return None
        g = np.where(kind == SPREAD, of, np.where(marked, key, np.repeat(name, per)))[take]
        none = pa.nulls(len(g), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(g), pa.array(s[take]), pa.array(size[take].astype(np.int32)), pa.array(np.zeros(len(g), bool)), none, none, pa.nulls(len(g), pa.list_(pa.int64()))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 5
        known: set[int] = set()
        for b in batches:
            kind = np.array(b.column(3), np.int64)
            if (docs := kind == DOC).any():
                d = b.filter(pa.array(docs))
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(d.num_rows, np.int64)), d.column(1), d.column(2), pa.array(np.ones(d.num_rows, bool)), d.column(4), d.column(5), d.column(6)], names=names)
                b = b.filter(pa.array(~docs))
            held = [np.append(h, np.array(c, np.int64)) for h, c in zip(held, b.columns[:5])]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if not cut and len(held[0]) > HOT_ALL:  # goes on under its key: a mark stays for the rest
                key = held[0][-1]
                mark = [np.array([key]), np.array([0]), np.array([0]), np.array([MARK]), np.array([key])]
                if (done := judge([np.append(m, h) for m, h in zip(mark, held)], known)) is not None:
                    yield done
                held = mark
                continue
            if cut and (done := judge([h[:cut] for h in held], known)) is not None:
                yield done
            held = [h[cut:] for h in held]
        if len(held[0]) and (done := judge(held, known)) is not None:
            yield done

    dealt = buckets.repartition("key").sortWithinPartitions("key", "s")
    return dealt.mapInArrow(common.lean(run), "g long, s long, size int, doc boolean, doc_id long, th long, bits array<long>")


def _with_sets(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b, x, y) of pairs (a, b), x and y being what is known (s, th, n, bits) of either set."""
    half = lambda name, to: known.select(F.col("s").alias(name), F.struct("th", "n", "bits").alias(to))
    return pairs.join(half("a", "x"), "a").join(half("b", "y"), "b")


def _possible(pairs: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, ta, tb), with the hash of a text of either set, of the pairs that sizes and bitmaps allow to be linked."""
    fine = f"least(x.n, y.n) * {den} >= greatest(x.n, y.n) * {num} and {few_bits_differ(num, den)}"
    return common.materialize(_with_sets(pairs, known).where(fine).select("a", "b", F.col("x.th").alias("ta"), F.col("y.th").alias("tb")), "pairs")


def _verified(pairs: DataFrame, docs: DataFrame, n: int, num: int, den: int, text: str) -> DataFrame:
    """(a, b, linked) of each of the pairs (a, b, ta, tb). a's text meets that of b; a set with many partners meets them in parts of PART pairs.

    Only the texts that some pair needs are read again and dealt out, compressed."""
    need = common.materialize(pairs.select(F.explode(F.array("ta", "tb")).alias("th")).distinct(), "needed")
    d = docs.select(F.xxhash64(text).alias("th"), F.coalesce(F.col(text), F.lit("")).alias(text))
    z = common.zip_texts(common.some_of(d, need, "th"), text=text).groupBy("th").agg(F.min("z").alias("z"))
    parts = pairs.groupBy("tb").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("k"))
    p = pairs.join(common.materialize(parts, "parts"), "tb").withColumn("part", F.expr("cast(pmod(hash(a), k) as int)"))
    left = p.join(z.withColumnRenamed("th", "ta"), "ta").select("b", "part", "a", "z")
    right = p.select("b", "part", "tb").distinct().join(z.withColumnRenamed("th", "tb"), "tb").select("b", "part", F.lit(None).cast("long").alias("a"), "z")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor().decompress
        other, of = np.zeros(0, U), None
        for whole in batches:
            for part in common.slices(whole, "z", 1 << 19):
                sets, border = shingle_sets(*common.flat_bytes(pa.array([unzip(x) for x in part.column(3).to_pylist()], pa.binary())), n)
                rows = []
                for i, (b, a) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist())):
                    own = sets[border[i] : border[i + 1]]
                    if a is None:
                        other, of = own, b
                        continue
                    assert of == b
                    both = int((other[np.minimum(np.searchsorted(other, own), len(other) - 1)] == own).sum()) if len(other) else 0
                    rows.append((a, b, den * both >= num * (len(own) + len(other) - both)))
                a, b, hit = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(hit, pa.bool_())], names=["a", "b", "linked"])

    met = left.unionByName(right).repartition("b", "part").sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())
    return common.materialize(met.mapInArrow(common.lean(run), "a long, b long, linked boolean"), "verified")


def _first_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """Every member against the least one of its bucket that lies in the band, if the sizes allow."""
    # Written, so that the join deals out both sides and a bucket with very many members can be split.
    lead = common.materialize(members.groupBy("g").agg(F.min(F.when(F.col("size") % 2 == 1, F.struct("s", "size"))).alias("l")), "leads")
    both = members.join(lead, "g").where("s <> l.s")
    x, y = F.expr("size div 2"), F.expr("l.size div 2")
    fine = both.where(F.least(x, y) * den >= F.greatest(x, y) * num)
    return fine.select(F.greatest("s", F.col("l.s")).alias("a"), F.least("s", F.col("l.s")).alias("b")).distinct()


def _rest_pairs(members: DataFrame, known: DataFrame, roots: DataFrame, done: DataFrame, best: int | None, num: int, den: int) -> DataFrame:
    """(a, b, ta, tb, cut): pairs, not done yet, of sets of different components in one bucket that sizes and bitmaps allow, with hashes of their texts.

    With `best`, so many of each two components of a bucket; `cut` names the buckets where that left out others."""
    m = members.join(roots.withColumnRenamed("node", "s"), "s", "left").select("g", "s", "size", F.coalesce("root", "s").alias("root"))
    m = common.materialize(m, "rooted")
    open_ = m.groupBy("g").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("k")).where("x <> y").select("g", F.ceil(F.col("k") / BLOCK).cast("int").alias("k"))
    m = m.join(common.materialize(open_, "open"), "g").join(known.select("s", F.expr(folded("bits", str(SKETCH // 64))).alias("bits"), "th"), "s").withColumn("i", F.expr("cast(pmod(xxhash64(s), k) as int)"))
    m = m.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select("g", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"), "s", "size", "root", "i", "bits", "th")
    names = ["a", "b", "ta", "tb", "cut"]

    def judge(rows: list[np.ndarray], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """(first members, second members, whether some pairs were left out) by place in the bucket"""
        x, y, s, size, root, i = rows
        n, own = size >> 1, size & 1
        found_a, found_b, far = [], [], []
        for at in range(0, len(s), 64):
            to = min(at + 64, len(s))
            p, q = n[at:to, None], n[None, :]
            # Each pair once; within one block, or between the two blocks that meet here.
            fine = (np.arange(at, to)[:, None] < np.arange(len(s))[None, :]) & (root[at:to, None] != root[None, :]) & ((own[at:to, None] | own[None, :]) == 1)
            fine &= (i[at:to, None] != i[None, :]) | (x[0] == y[0])
            fine &= np.minimum(p, q) * den >= np.maximum(p, q) * num
            a, b = np.nonzero(fine)
            if len(a):
                d = np.bitwise_count(bits[at + a] ^ bits[b]).sum(axis=1)
                ok = d <= (den - num) * (n[at + a] + n[b]) // (den + num)
                found_a.append(at + a[ok])
                found_b.append(b[ok])
                far.append(d[ok])
        if not found_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), False
        cut = False
        a, b, d = np.concatenate(found_a), np.concatenate(found_b), np.concatenate(far)
        if best is not None:
            r, t = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            order = np.lexsort((d, t, r))
            a, b, r, t = a[order], b[order], r[order], t[order]
            first = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (t[1:] != t[:-1]))) if len(a) else np.zeros(0, int)
            keep = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a)))) < best
            a, b, cut = a[keep], b[keep], not keep.all()
        swap = s[a] < s[b]
        return np.where(swap, b, a), np.where(swap, a, b), cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(b: pa.Table) -> pa.RecordBatch:
            cols = [np.array(b.column(c).combine_chunks(), np.int64) for c in range(1, 7)]
            bits = np.array(b.column(7).combine_chunks().flatten(), np.int64).view(U).reshape(-1, SKETCH // 64)
            a, c, cut = judge(cols, bits)
            who, th = cols[2], np.array(b.column(8).combine_chunks(), np.int64)
            more = [b.column(0)[0].as_py()] if cut else []
            out = [pa.array([*x.tolist(), *[None] * len(more)], pa.int64()) for x in (who[a], who[c], th[a], th[c])]
            return pa.RecordBatch.from_arrays([*out, pa.array([None] * len(a) + more, pa.int64())], names=names)

        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([np.array(b.column(c), np.int64) for c in range(3)], axis=1)
            cut = np.append(0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1)
            if held and tuple(key[0]) != tuple(held[-1].column(c)[0].as_py() for c in range(3)):
                yield flush(pa.Table.from_batches(held))
                held = []
            for u, v in zip(cut, np.append(cut[1:], b.num_rows)):
                held.append(b.slice(u, v - u))
                if v < b.num_rows:
                    yield flush(pa.Table.from_batches(held))
                    held = []
        if held:
            yield flush(pa.Table.from_batches(held))

    dealt = m.repartition("g", "x", "y").sortWithinPartitions("g", "x", "y", "s")
    found = dealt.mapInArrow(common.lean(run), ", ".join(f"{c} long" for c in names)).distinct()
    # Sets of more than SKETCH elements have larger bitmaps; the few that are asked for are looked up.
    wide = known.where(F.col("n") > SKETCH)
    half = lambda name, to: wide.select(F.col("s").alias(name), F.struct("n", "bits").alias(to))
    asked = found.join(done.select("a", "b"), ["a", "b"], "left_anti").join(half("a", "x"), "a", "left").join(half("b", "y"), "b", "left")
    return common.materialize(asked.where(f"x is null or y is null or {few_bits_differ(num, den)}").select(*names), "pairs")


def classes(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, text: str = "text") -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, component_id (the least doc_id that links lead to) of each row of docs (doc_id, text).

    Two documents are linked if den * |intersection| >= num * |union| of their sets of n-word shingles."""
    gathered = common.materialize(_gathered(_buckets(docs, n, num, den, text)), "gathered")
    sets = gathered.where("doc").select("doc_id", "th", F.col("size").cast("long").alias("n"), "s", "bits")
    members = common.materialize(gathered.where("not doc").groupBy("g", "s").agg(F.max("size").alias("size")), "members")
    known = common.materialize(sets.where("n > 0").groupBy("s").agg(*[F.min(c).alias(c) for c in ("th", "n", "bits")]), "known")
    done = _verified(_possible(_first_pairs(members, num, den), known, num, den), docs, n, num, den, text)
    roots = components(done.where("linked"))
    for best in (BEST, None):
        rest = _rest_pairs(members, known, roots, done, best, num, den)
        more = _verified(rest.where("a is not null").drop("cut"), docs, n, num, den, text)
        linked = not more.where("linked").isEmpty()
        done = done.unionByName(more)
        roots = components(done.where("linked")) if linked else roots
        cut = common.materialize(rest.where("cut is not null").select(F.col("cut").alias("g")).distinct(), "cut")
        if best is None or cut.isEmpty():
            break
        members = common.some_of(members, cut, "g")
    # Least identifiers per set, then per component; documents join by set only.
    per_set = sets.where("n > 0").groupBy("s").agg(F.min("doc_id").alias("least")).join(roots.withColumnRenamed("node", "s"), "s", "left").withColumn("root", F.coalesce("root", "s"))
    per_root = per_set.groupBy("root").agg(F.min("least").alias("component_id"))
    named = per_set.join(common.materialize(per_root, "names"), "root").select("s", "component_id")
    out = sets.join(named, "s", "left")
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s FROM w),
e AS (SELECT r, len(s) AS n, unnest(s) AS x FROM s),
i AS (SELECT a.r AS p, b.r AS q, count(*) AS common, any_value(a.n) AS n, any_value(b.n) AS m FROM e a JOIN e b ON a.x = b.x AND a.r < b.r GROUP BY a.r, b.r),
l AS (SELECT p, q FROM i WHERE 100 * common >= 85 * (n + m - common)),
u AS (SELECT p, q FROM l UNION ALL SELECT q, p FROM l),
c AS (SELECT r AS node, r AS seen FROM s UNION SELECT c.node, u.q FROM c JOIN u ON u.p = c.seen)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE k.least END AS component_id
FROM s JOIN (SELECT c.node, min(o.doc_id) AS least FROM c JOIN s o ON o.r = c.seen GROUP BY c.node) k ON k.node = s.r
"""
