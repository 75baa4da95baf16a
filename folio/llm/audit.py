"""How filters of documents interact: what each one removes alone, after others and in every order.

Five filters give every document a mask of failures. Four look at its own text. The fifth, a copy of a smaller identifier's text, is found by
partition refinement: documents are split by their number of code points, then by the hashes of successive blocks (code points up to 64, 512,
4,096 and the rest), and each time those left alone are dropped; the full texts of the rest are compared by their bytes.

All orders are then told from the counts of masks: at most 32 rows per part, whatever the number of documents. A document that fails m filters is
removed by each of them, being the first, in 120 / m of the 120 orders.

Defined results: a null text counts as empty and has no words (0 words fail A, and B is 0 < 0: passed); a null source is the part ''; an absent label is
none, of several labels of an identifier one that says so is enough; a null identifier is neither smaller than others nor has smaller ones;
rows that share the smallest identifier are not copies of each other; an empty table gives an empty result; only doc_id, text, source are read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm import bodies, common

FILTERS = "ABCDE"
#: Ends of the blocks, in code points; the last block is the rest.
BLOCKS = (64, 512, 4096)
CAPITALS, SIGNS = bytes(range(65, 91)), b"#$%&*|"


def _mask(text: bytes, points: int) -> int:
    """Bits 1, 2, 4, 8 for failing A (under 200 words), B (under half of the words distinct), C (over 2 % capitals), D (a sign). bytes.split() splits at `[\\x20\\x09-\\x0D]`."""
    words = text.split()
    few, same = len(words) < 200, 100 * len(set(words)) < 50 * len(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return few + 2 * same + 4 * (100 * capitals > 2 * points) + 8 * any(c in text for c in SIGNS)


def masks() -> Column:
    """A column function of (text, its length): its mask."""

    @F.arrow_udf("int")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        common.settle()
        for texts, points in batches:
            yield pa.array([_mask(t.as_py(), n) for t, n in zip(texts.cast(pa.binary()), points.to_pylist())], pa.int32())
        common.trim()

    return run


def classes(text: Column, blocks: tuple[int, ...] = BLOCKS, bits: int = 64) -> list[Column]:
    """The names of a text's class after each split: by length, then by each block. Only `bits` of a block's hash count (fewer in tests)."""
    edges = [0, *blocks, None]
    names = [F.length(text).cast("long")]
    for lo, hi in itertools.pairwise(edges):
        block = F.substring(text, lo + 1, (hi if hi is not None else 2**31 - 1 - lo) - lo)
        names.append(F.xxhash64(names[-1], F.shiftright(F.xxhash64(block), 64 - bits)))
    return names


def refined(rows: DataFrame, names: list[str]) -> DataFrame:
    """The names (of the last split) of classes that still have two rows or more: split by split, what is left alone is dropped."""
    live = rows.select(*names)
    for at, name in enumerate(names):
        many = common.materialize(live.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name), f"split{at}")
        if at == len(names) - 1:
            return many
        live = common.materialize(common.some_of(live.select(*names[at:]), many, name).select(*names[at + 1 :]), f"left{at}")
    raise AssertionError


def _bodies(texts: DataFrame) -> DataFrame:
    """(doc_id, part, mask, cls, sha, z) of texts (doc_id, part, mask, cls, text); z, the text compressed, once for each (cls, sha) of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, str]] = set()
        pack = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for b in common.slices(whole, "t"):
                shas, packs = [], []
                for cls, t in zip(b.column(3).to_pylist(), b.column(4).to_pylist()):
                    shas.append(hashlib.sha256(t).hexdigest())
                    packs.append(pack(t) if (cls, shas[-1]) not in seen and not seen.add((cls, shas[-1])) else None)
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(shas, pa.string()), pa.array(packs, pa.binary())], names=["doc_id", "part", "mask", "cls", "sha", "z"])

    t = texts.select("doc_id", "part", "mask", "cls", F.col("text").cast("binary").alias("t"))
    return t.mapInArrow(common.lean(run), "doc_id long, part string, mask int, cls long, sha string, z binary")


def failures(docs: DataFrame, blocks: tuple[int, ...] = BLOCKS, bits: int = 64) -> DataFrame:
    """(doc_id, part, mask) of each document; bit k of the mask: it fails filter k."""
    text = common.empty_text()
    names = [f"k{i}" for i in range(len(blocks) + 2)]
    split = dict(zip(names, classes(F.col("text"), blocks, bits)))
    whole = docs.select(F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    rows = whole.withColumns(split).select("doc_id", "part", masks()("text", "k0").alias("mask"), *names)
    rows = common.materialize(rows, "masks")
    twice = refined(rows, names)
    cls = names[-1]
    found = common.some_of(whole.withColumn(cls, split[cls]), twice, cls).withColumn("n", F.length("text").cast("long"))
    found = common.materialize(_bodies(found.select("doc_id", "part", masks()("text", "n").alias("mask"), F.col(cls).alias("cls"), "text")), "bodies")
    same = bodies.confirmed(found.where("z is not null").select(F.col("cls").alias("key"), "sha", "z"))
    least = found.groupBy("cls", "sha").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1 and least is not null")
    least = common.materialize(least.join(same.withColumnRenamed("key", "cls"), ["cls", "sha"]).select("cls", "sha", "least"), "least")
    marked = found.drop("z").join(least, ["cls", "sha"], "left")
    copies = marked.select("doc_id", "part", F.when(F.col("doc_id") > F.col("least"), F.col("mask") + 16).otherwise(F.col("mask")).alias("mask"))
    few = twice.count() <= 2_000_000
    alone = rows.join(F.broadcast(twice) if few else twice, cls, "left_anti").select("doc_id", "part", "mask")
    return alone.unionByName(copies)


def _steps() -> Column:
    """An array of the steps of all orders: filter_order, step, b (bit of the step's filter), e (bits of the earlier ones)."""
    rows = []
    for order in map("".join, itertools.permutations(FILTERS)):
        bits = [1 << FILTERS.index(c) for c in order]
        rows += [(order, i + 1, bits[i], sum(bits[:i])) for i in range(len(bits))]
    return F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(i).alias("step"), F.lit(b).alias("b"), F.lit(e).alias("e")) for o, i, b, e in rows])


def interactions(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from failed (doc_id, part, mask) and labels (doc_id, quality, toxic)."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # Rows that share an identifier, null too, are counted before they meet the labels.
    by_id = failed.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n")).join(known, "doc_id", "left")
    n, yes = F.col("n"), lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0))
    by_mask = by_id.groupBy("part", "mask").agg(F.sum(n).alias("n"), yes("good").alias("good"), yes("toxic").alias("toxic"))
    listed = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))  # 32 at most
    each = listed.select("part", "m", F.explode(_steps()).alias("s")).select("part", "m", "s.*")
    total = lambda what, where: F.expr(f"aggregate(filter(m, x -> {where}), 0L, (a, x) -> a + {what})")
    here = "x.mask & b <> 0 and x.mask & e = 0"
    return each.select(
        "part", "filter_order", "step", total("x.n", "x.mask & (b | e) = 0").alias("kept"), total("x.n", here).alias("removed"), total("x.n", "x.mask & b <> 0 and x.mask & e <> 0").alias("redundant"),
        total("x.n", "x.mask = b").alias("unique_fails"), total("x.good", here).alias("good_lost"), total("x.toxic", here).alias("toxic_lost"), total("x.n * (120 div bit_count(x.mask))", "x.mask & b <> 0").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, blocks: tuple[int, ...] = BLOCKS, bits: int = 64) -> DataFrame:
    return interactions(failures(docs, blocks, bits), labels)


ORACLE = r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
f AS (SELECT doc_id, part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
  regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails FROM w),
l AS (SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, fails, count(*) AS n, count(*) FILTER (coalesce(good, false)) AS good, count(*) FILTER (coalesce(toxic, false)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
o AS (SELECT '' AS filter_order UNION ALL SELECT filter_order || c FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE NOT contains(filter_order, c)),
s AS (SELECT filter_order, unnest(range(1, 6))::INTEGER AS step FROM o WHERE length(filter_order) = 5),
x AS (SELECT d.*, s.*, substring(filter_order, step, 1) AS c, fails[ascii(substring(filter_order, step, 1)) - 64] AS fails_it,
  len(list_filter(range(1, step), lambda i: fails[ascii(substring(filter_order, i, 1)) - 64])) > 0 AS gone FROM d, s),
a AS (SELECT part, filter_order, step, any_value(c) AS c, coalesce(sum(n) FILTER (NOT fails_it AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (fails_it AND NOT gone), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (fails_it AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails_it AND len(list_filter(fails, lambda z: z)) = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (fails_it AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (fails_it AND NOT gone), 0)::BIGINT AS toxic_lost FROM x GROUP BY part, filter_order, step)
SELECT * EXCLUDE (c), (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley FROM a
"""
