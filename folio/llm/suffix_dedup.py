"""Removing repeated byte strings with longest-previous-factor arrays over suffixes.

A byte goes if a string of `width` bytes that covers it also starts elsewhere (keep="none"), or starts earlier, by document and then
position (keep="first").

1. Every window of `width` bytes gets its anchor (winnow.py): equal windows have equal anchors at equal places. Consecutive windows of one
   anchor are a run; its context is the bytes they cover. One row per run is dealt out by the hash of the anchor; runs alone with theirs are done.
2. The contexts of the others are gathered by anchor, as bytes. The suffixes that begin at the runs' starts are sorted; the previous and next smaller
   position in suffix order give each its longest earlier match (the longest previous factor); the same over reversed positions gives the longest
   later one. What these matches cover is done, most often the whole run. Where something is left, all suffixes of the anchor's unlike contexts are
   sorted, capped at `width`, and the same arrays decide window by window.
3. Anchors with very many runs or unlike contexts are not gathered: their windows are counted by 128-bit hashes, salted, in DataFrame operations.
   Each task counts its anchors in a sketch, so what is frequent is spread before the shuffle.
4. Each distinct text meets its removed stretches once; the results go to the documents by the hash of their text.

Defined results: null text is empty; texts are UTF-8 bytes; repeated rows and equal texts are copies of each other (with keep="first" all
but those of the least identifier go); texts under `width` bytes stay; matches do not cross documents; an empty table gives an empty table.
Equal texts are found by 64-bit hashes, so that their copies are counted before anything is dealt out; matches are decided on bytes but for 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import common, winnow

WIDTH, GRAM = 200, 64
#: An anchor with so many runs in a task, or in all, is not gathered.
HOT_HERE, HOT_ALL = 128, 50_000
SALTS = 64
#: An anchor with so many unlike contexts is not gathered either: a group's windows must fit a worker.
HOT_EDGES = 1_500
#: Suffixes sorted at once; bytes of contexts held at once, but for one anchor's.
BATCH, HELD = 30_000, 4 << 20
#: Cells of the sketch of a task's anchors.
CELLS = 1 << 21
#: So many text hashes (8 bytes each) are broadcast; more are joined.
MOST_BROADCAST_ROWS = 2_000_000
ALONE, SHARED, HOT = range(3)


# ---- suffix order


def longest_previous(position: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """The longest-previous-factor array: for each suffix, in suffix order, its longest match with one of smaller position.

    lcp[i] is that of suffixes i - 1 and i. The previous and next smaller positions hold the best matches; they are found by
    pointer jumping, with the least lcp on the way."""
    n = len(position)
    out = np.zeros(n, np.int64)
    for step in (-1, 1):
        ptr = np.arange(n) + step
        # least[i]: the least lcp between i and ptr[i]
        least = lcp.copy() if step < 0 else np.append(lcp[1:], 0)
        end = -1 if step < 0 else n
        todo = np.flatnonzero(ptr != end)
        while len(todo):
            p = ptr[todo]
            todo = todo[position[p] >= position[todo]]
            p = ptr[todo]
            ptr[todo], least[todo] = ptr[p], np.minimum(least[todo], least[p])
            todo = todo[ptr[todo] != end]
        found = ptr != end
        out[found] = np.maximum(out[found], least[found])
    return out


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The number of first bytes that each row, in that order, has in common with the one before it; rows: n x width bytes."""
    n, width = rows.shape
    if pad := -width % 8:
        rows = np.concatenate([rows, np.zeros((n, pad), np.uint8)], axis=1)
    words = rows.view(np.uint64)
    lcp = np.zeros(n, np.int64)
    most = max(1, (1 << 18) // rows.shape[1])  # rows compared at once stay in the cache
    for at in range(1, n, most):
        part = words[order[at - 1 : at + most]]
        differ = part[1:] != part[:-1]
        word = differ.argmax(axis=1)
        row = np.arange(len(word))
        byte = (part[row + 1, word] ^ part[row, word]).view(np.uint8).reshape(-1, 8) != 0
        lcp[at : at + most] = np.where(differ[row, word], 8 * word + byte.argmax(axis=1), width)
    return lcp


def suffix_order(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes of data at starts by their first `width` bytes, lcp of neighbours up to width)."""
    rows = np.ndarray(len(data) - width + 1, f"V{width}", data, strides=(1,))[starts]
    order = np.argsort(rows, kind="stable")
    return order, common_prefixes(rows.view(np.uint8).reshape(-1, width), order)


def longest_matches(order: np.ndarray, lcp: np.ndarray, position: np.ndarray, keep: str) -> np.ndarray:
    """The longest match of each suffix with one elsewhere (keep="none") or at a smaller position (keep="first")."""
    pos = position[order]
    best = longest_previous(pos, lcp)
    if keep == "none":
        best = np.maximum(best, longest_previous(-pos, lcp))
    out = np.zeros(len(order), np.int64)
    out[order] = best
    return out


def context_order(texts: list[bytes], first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the strings, equal ones in the order `first`; lcp of neighbours)."""
    order = np.array(sorted(first.tolist(), key=texts.__getitem__), np.int64)
    size = np.array([len(t) for t in texts])
    wide = int(size.max())
    lcp = common_prefixes(np.array(texts, f"S{wide}").view(np.uint8).reshape(len(texts), wide), order)
    lcp[1:] = np.minimum(lcp[1:], np.minimum(size[order[1:]], size[order[:-1]]))  # rows are padded
    return order, lcp


# ---- the distributed parts


def _runs(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """A row per run: anchor, hot (1: not to be gathered, dealt out by text; 2: a mark for the others), ctx, th, ord, place (first window * 256 + windows - 1)."""
    schema = "anchor long, hot int, ctx long, th long, ord long, place long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        marked: set[int] = set()
        sketch = np.zeros(CELLS, np.int32)
        for whole in batches:
            for b in common.slices(whole, "t", 1 << 20):
                th, order = np.array(b.column(0), np.int64), np.array(b.column(1), np.int64)
                # Copies of a text here need no rows of their own: their number is counted apart.
                new = [i for i, x in enumerate(th.tolist()) if x not in seen and not seen.add(x)]
                b, th, order = b.take(pa.array(new, pa.int64())), th[new], order[new]
                raw, off = common.flat_bytes(b.column(2))
                if not len(raw):
                    continue
                lo, hi, at, anchor, ctx = winnow.contexts(raw, off, width, gram)
                ctx ^= common.mix((at - lo).astype(np.uint64))
                doc = np.searchsorted(off, lo, "right") - 1
                cell = ((anchor >> np.uint64(20)) % np.uint64(CELLS)).astype(np.int64)
                np.add.at(sketch, cell, 1)
                hot = sketch[cell] >= HOT_HERE
                key = np.where(hot, common.mix(anchor + th[doc].astype(np.uint64)), anchor)
                marks = np.array([x for x in np.unique(anchor[hot]).tolist() if x not in marked and not marked.add(x)], np.uint64)
                pad = np.zeros(len(marks), np.int64)
                place = (lo - off[doc]) * 256 + (hi - lo)
                cols = [np.append(key, marks).view(np.int64), np.append(hot.astype(np.int32), pad.astype(np.int32) + 2), np.append(ctx.view(np.int64), pad), np.append(th[doc], pad), np.append(order[doc], pad), np.append(place, pad)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select("th", "ord", F.col("text").cast("binary").alias("t")).mapInArrow(common.lean(run), schema)


def _judged(runs: DataFrame) -> DataFrame:
    """The runs that are not alone, SHARED or HOT; runs are gathered by anchor in one exchange, and read in order."""
    schema = "anchor long, kind int, th long, ord long, place long"

    def judge(x: np.ndarray) -> pa.RecordBatch | None:
        """x: columns anchor, hot, ctx, th, ord, place of whole anchors."""
        anchor, hot, ctx, th, order, place = x
        same_anchor = np.append(False, anchor[1:] == anchor[:-1])
        a0 = np.flatnonzero(~same_anchor)
        per_anchor = np.diff(np.append(a0, len(anchor)))
        unlike = np.add.reduceat((~(same_anchor & np.append(False, ctx[1:] == ctx[:-1]))).astype(np.int64), a0)
        wide = (np.maximum.reduceat(hot, a0) == 2) | (per_anchor > HOT_ALL) | (unlike > HOT_EDGES)
        kind = np.repeat(np.where(wide, HOT, np.where(per_anchor > 1, SHARED, ALONE)), per_anchor)
        kind[hot == 1] = HOT
        kind[hot == 2] = ALONE
        k = kind != ALONE
        if not k.any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(anchor[k]), pa.array(kind[k].astype(np.int32)), pa.array(th[k]), pa.array(order[k]), pa.array(place[k])], names=[c.split()[0] for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 6
        for b in batches:
            held = [np.append(h, np.array(c, np.int64)) for h, c in zip(held, b.columns)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if not cut and len(held[0]) > HOT_ALL:  # more of one anchor than is gathered: all its rows get the same kind, and a mark stays for the rest
                done = judge(held)
                head = held[0][-1:]
                if done is not None:
                    yield done
                held = [head, np.array([2]), *[np.zeros(1, np.int64)] * 4]
                continue
            if cut and (done := judge([h[:cut] for h in held])) is not None:
                yield done
            held = [h[cut:] for h in held]
        if len(held[0]) and (done := judge(held)) is not None:
            yield done

    dealt = runs.repartition("anchor").sortWithinPartitions("anchor", "ctx", "ord", "th", "place")
    return dealt.mapInArrow(common.lean(run), schema)


def _contexts(texts: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """rows (anchor, kind, th, ord, place) of texts (th, z) with the bytes of their context."""
    lists = rows.groupBy("th").agg(F.collect_list(F.struct("anchor", "kind", "ord", "place")).alias("rows"))
    joined = common.some_of(texts, lists.select("th"), "th", MOST_BROADCAST_ROWS).groupBy("th").agg(F.min("z").alias("z")).join(lists, "th")
    schema = "anchor long, kind int, th long, ord long, place long, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for b in common.slices(whole, "z", 1 << 20):
                anchor, kind, order, place = b.column(2).flatten().flatten()
                many = np.diff(np.array(b.column(2).offsets))
                lo = np.array(place, np.int64) >> 8
                hi = lo + (np.array(place, np.int64) & 255) + width
                bytes_, at, lo, hi = [], 0, lo.tolist(), hi.tolist()
                for z, n in zip(b.column(1).to_pylist(), many.tolist()):
                    text = unzip(z)
                    bytes_ += [text[i:j] for i, j in zip(lo[at : at + n], hi[at : at + n])]
                    at += n
                th = np.repeat(np.array(b.column(0), np.int64), many)
                yield pa.RecordBatch.from_arrays([anchor, kind, pa.array(th), order, place, pa.array(bytes_, pa.binary())], names=[x.split()[0] for x in schema.split(", ")])

    return joined.select("th", "z", "rows").mapInArrow(common.lean(run), schema)


def _matched(contexts: DataFrame, width: int, keep: str) -> DataFrame:
    """(th, ord, place) of the runs of windows that have a match, among the contexts of each anchor."""

    def dense(texts: list[bytes], lo: np.ndarray, size: np.ndarray, ids: list[np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, first window, last window) of the matches among all windows of the texts."""
        begin = np.cumsum(np.append(0, [len(t) for t in texts]))[:-1]
        ctx = np.repeat(np.arange(len(texts)), size)
        inside = np.arange(len(ctx)) - np.repeat(np.cumsum(size) - size, size)
        place = np.lexsort((lo[ctx] + inside, ids[0][ctx], ids[1][ctx]))
        position = np.empty(len(ctx), np.int64)
        position[place] = np.arange(len(ctx))
        order, lcp = suffix_order(np.frombuffer(b"".join(texts), np.uint8), begin[ctx] + inside, width)
        at = np.flatnonzero((longest_matches(order, lcp, position, keep) >= width) & wanted[ctx])
        if not len(at):
            return at, at, at
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(ctx[at]) != 0)) + 1
        first, last = at[np.append(0, cut)], at[np.append(cut, len(at)) - 1]
        return ctx[first], inside[first], inside[last]

    def judge(ints: list[np.ndarray], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        anchor, th, order, place = ints
        lo, size = place >> 8, (place & 255) + 1
        by = np.lexsort((place, th, order))
        position = np.empty(len(by), np.int64)
        position[by] = np.arange(len(by))
        suffixes, lcp = context_order(texts, by)
        best = longest_matches(suffixes, lcp, position, keep)
        length = size + width - 1
        found = np.maximum(best - width + 1, 0)  # windows that the match of a run's start covers
        out = [(np.flatnonzero(found), 0 * found[found > 0], found[found > 0] - 1)]
        # Of equal contexts the first stands for all; the others are wholly matched.
        lead = np.zeros(len(by), bool)
        lead[suffixes] = (lcp < length[suffixes]) | np.append(True, length[suffixes[1:]] != length[suffixes[:-1]])
        a0 = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        per = np.diff(np.append(a0, len(anchor)))
        left = found < size
        open_ = np.logical_or.reduceat(left, a0) & (np.add.reduceat(lead.astype(np.int64), a0) > 1)
        rows = np.flatnonzero(np.repeat(open_, per) & lead)
        suffixes_of = np.cumsum(size[rows])
        at = 0
        while at < len(rows):
            # Whole anchors, of about BATCH suffixes.
            to = int(np.searchsorted(suffixes_of, (suffixes_of[at - 1] if at else 0) + BATCH, "right"))
            to = int(np.searchsorted(anchor[rows], anchor[rows[max(to, at + 1) - 1]], "right"))
            r = rows[at:to]
            c, first, last = dense([texts[i] for i in r], lo[r], size[r], [th[r], order[r]], left[r])
            out.append((r[c], first, last))
            at = to
        row, first, last = (np.concatenate(x) for x in zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(th[row]), pa.array(order[row]), pa.array((lo[row] + first) * 256 + (last - first))], names=["th", "ord", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = [np.zeros(0, np.int64)] * 4, []
        for whole in batches:
            for b in common.slices(whole, "bytes", HELD):
                held = [np.append(h, np.array(b.column(i), np.int64)) for h, i in zip(held, (0, 2, 3, 4))]
                texts += b.column(5).to_pylist()
                if cut := int(np.searchsorted(held[0], held[0][-1])):
                    yield from judge([h[:cut] for h in held], texts[:cut])
                    held, texts = [h[cut:] for h in held], texts[cut:]
        if texts:
            yield from judge(held, texts)

    return contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(common.lean(run), "th long, ord long, place long")


def _hot_windows(contexts: DataFrame, width: int, keep: str) -> DataFrame:
    """(th, ord, place) of the windows of hot anchors that have a match: counted by their hashes in two salted levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in common.slices(whole, "bytes", 1 << 18):
                raw, off = common.flat_bytes(b.column(5))
                place, th, order = (np.array(b.column(i), np.int64) for i in (4, 2, 3))
                size = (place & 255) + 1
                row = np.repeat(np.arange(len(place)), size)
                inside = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                s = off[row] + inside
                h = common.range_hashes(raw, s, s + width)
                g = common.range_hashes(raw ^ np.uint8(0x5A), s, s + width)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(th[row]), pa.array(order[row]), pa.array(((place[row] >> 8) + inside) * 256)], names=["h", "g", "th", "ord", "place"])

    w = contexts.mapInArrow(common.lean(run), "h long, g long, th long, ord long, place long").withColumn("salt", F.pmod(F.hash("th"), F.lit(SALTS)))
    part = w.groupBy("h", "g", "salt").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "th", "place")).alias("first"))
    over = Window.partitionBy("h", "g")
    total = part.select("h", "g", "salt", F.sum("n").over(over).alias("n"), F.min("first").over(over).alias("first"))
    both = w.join(total, ["h", "g", "salt"]).where("n > 1")
    return (both if keep == "none" else both.where(F.struct("ord", "th", "place") != F.col("first"))).select("th", "ord", "place")


def removed(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, keep: str = "none", text: str = "text", key: str = "doc_id", with_text: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 of each row of docs; with_text: kept (binary), the bytes that stay."""
    if keep not in ("none", "first"):
        raise ValueError(keep)
    if gram & (gram - 1) or not gram <= width <= gram + 255:
        raise ValueError("gram is a power of two, and width at most 255 more")
    d = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    d = d.withColumn("ord", F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)))
    long_enough = d.where(F.octet_length("text") >= width)
    copies = d.groupBy("th").agg(F.count(F.lit(1)).alias("copies"), F.min("ord").alias("first"))
    if keep == "first":  # of equal texts the first stands for all: later ones are removed whole
        first = common.materialize(copies.select("th", F.col("first").alias("ord")), "firsts")
        long_enough = long_enough.join(first, ["th", "ord"])
    judged = common.materialize(_judged(_runs(long_enough, width, gram)), "runs")

    texts = common.zip_texts(d)
    contexts = common.materialize(_contexts(texts, judged, width), "contexts")
    gone = _matched(contexts.where(F.col("kind") == SHARED), width, keep).unionByName(_hot_windows(contexts.where(F.col("kind") == HOT), width, keep))
    stretches = gone.groupBy("th").agg(F.collect_list("place").alias("places"))
    each = texts.join(copies, "th").join(stretches, "th", "left").select("th", "z", "copies", "first", "places")
    fields = "th long, copies long, first long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for b in common.slices(whole, "z", 1 << 20):
                rows = []
                for i, z in enumerate(b.column(1).to_pylist()):
                    raw = np.frombuffer(unzip(z), np.uint8) if z else np.zeros(0, np.uint8)
                    gone = np.zeros(len(raw), bool)
                    if keep == "none" and b.column(2)[i].as_py() > 1 and len(raw) >= width:
                        gone[:] = True
                    elif b.column(4)[i].is_valid:
                        place = np.array(b.column(4)[i].values, np.int64)
                        change = np.zeros(len(raw) + 1, np.int32)
                        np.add.at(change, place >> 8, 1)
                        np.add.at(change, (place >> 8) + (place & 255) + width, -1)
                        gone = np.cumsum(change[:-1]) > 0
                    kept = raw[~gone].tobytes()
                    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    rows.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
                cols = list(zip(*rows))[: 4 + with_text]
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), *[pa.array(c, t) for c, t in zip(cols, types)]], names=[x.split()[0] for x in fields.split(", ")])

    values = ["copies", "first", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    # Written, so that the join below deals out both sides and a text with very many copies can be split.
    result = common.materialize(each.mapInArrow(common.lean(cut), fields).groupBy("th").agg(*[F.min(c).alias(c) for c in values]), "results")
    out = d.select("doc_id", "ord", "th").join(result, "th")
    if keep == "first":  # of equal texts only those of the least identifier keep anything
        later = (F.col("copies") > 1) & (F.col("ord") > F.col("first")) & (F.col("n_bytes") >= width)
        nothing = F.lit(hashlib.sha256(b"").hexdigest())
        out = out.withColumns({"n_removed": F.when(later, F.col("n_bytes")).otherwise(F.col("n_removed")), "n_spans": F.when(later, 1).otherwise(F.col("n_spans")).cast("long"), "kept_sha256": F.when(later, nothing).otherwise(F.col("kept_sha256"))})
        if with_text:
            out = out.withColumn("kept", F.when(later, F.lit(b"")).otherwise(F.col("kept")))
    return out.select(F.col("doc_id").alias(key), *values[2:])


#: All windows of 200 bytes, counted by MD5; covered stretches by gaps and islands.
ORACLE = """
WITH b AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, b, unnest(range(octet_length(b) - 199)) AS s FROM b WHERE octet_length(b) >= 200),
k AS (SELECT r, s, md5(b[s + 1 : s + 200]) AS k FROM w),
d AS (SELECT k FROM k GROUP BY k HAVING count(*) > 1),
h AS (SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS p FROM k SEMI JOIN d USING (k)),
i AS (SELECT r, s, sum(CASE WHEN p IS NULL OR s - p > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY s) AS i FROM h),
g AS (SELECT r, i, min(s) AS a, max(s) + 200 AS z FROM i GROUP BY r, i),
n AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS before, lead(a) OVER (PARTITION BY r ORDER BY a) IS NULL AS last FROM g),
c AS (SELECT n.r, sum(z - a)::BIGINT AS gone, count(*) AS spans, string_agg(hex(b[before + 1 : a]) || CASE WHEN last THEN hex(b[z + 1 : octet_length(b)]) ELSE '' END, '' ORDER BY a) AS kept FROM n JOIN b ON b.r = n.r GROUP BY n.r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(CASE WHEN c.r IS NULL THEN b ELSE unhex(kept) END) AS kept_sha256
FROM b LEFT JOIN c ON c.r = b.r
"""
