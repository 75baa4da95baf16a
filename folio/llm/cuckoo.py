"""Exact deduplication by an index of live digests: a sharded cuckoo filter before bucketed content.

The index holds, for each shard of the 64-bit digests, a cuckoo filter (4 marks of 16 bits a bucket), and its members: a
row per live document with its digest. Documents come and go in batches:

insert: a digest that the filter does not hold is new, and its text is never looked at again. One that it holds, be it of an
earlier member or of this batch, is a hit: the texts of all its documents are brought together, bucketed by digest, and compared by
their bytes, so digests that clash are told apart. Then the filter takes each new live digest once.
delete: digests without a member left go out of the filter, one mark each.
A shard whose filter is full is built anew, larger, from its stored keys.

Before rows are dealt out to shards each task runs its digests through a filter of its own, which lets a digest through twice at most
(once as new, once as a hit). So copies cost a shard two rows a task, and no task ever holds a group of copies.

Defined results: a null text counts as empty; texts are equal when identical after deleting `[\\x20\\x09-\\x0D]`; of equal texts the row with the
most code points in the original text, then the smallest identifier (null last) stays; repeated rows count each, one of them stays; an
empty table gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import bodies, common

BLANK = b" \t\n\x0b\f\r"
SLOTS, MARK_BITS, LOAD, KICKS = 4, 16, 0.9, 200
SHARDS = 256
#: A row's number is batch * 2**52 + partition * 2**33 + row of the partition.
BATCH = 52
MEMBER = "row long, doc_id long, n_points long, digest long, text_sha256 string, shard int"


class CuckooFilter:
    """Marks of 64-bit keys. A mark lies in one of two buckets, each found from the other and the mark, so that it moves or goes without its key."""

    def __init__(self, buckets: int = 16, cells: bytes | None = None):
        self.cells = np.zeros((buckets, SLOTS), np.uint16) if cells is None else np.frombuffer(cells, np.uint16).reshape(-1, SLOTS).copy()
        self.used = (self.cells != 0).sum(1)  # taken slots come first

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = common.mix(keys.view(np.uint64))
        mark = np.maximum(h >> np.uint64(64 - MARK_BITS), np.uint64(1)).astype(np.uint16)
        return mark, (h & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def _other(self, mark: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ (common.mix(mark.astype(np.uint64)) & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, at = self._places(keys)
        return ((self.cells[at] == mark[:, None]) | (self.cells[self._other(mark, at)] == mark[:, None])).any(1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if they don't fit; the filter is then to be built anew from its keys."""
        if self.used.sum() + len(keys) > LOAD * self.cells.size:
            return False
        mark, at = self._places(keys)
        for turn in range(KICKS):
            if not len(mark):
                return True
            order = np.argsort(at, kind="stable")
            mark, at = mark[order], at[order]
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            nth = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
            slot = self.used[at] + nth
            fits = slot < SLOTS
            self.cells[at[fits], slot[fits]] = mark[fits]
            # The first that finds a bucket full takes the place of another mark; in even turns all just try their other bucket.
            kicks = ~fits & (nth == 0) if turn % 2 else np.zeros(len(at), bool)
            out = (mark[kicks].astype(np.int64) + turn) % SLOTS
            victims = self.cells[at[kicks], out]
            self.cells[at[kicks], out] = mark[kicks]
            np.add.at(self.used, at[fits], 1)
            rest = np.where(kicks, 0, mark)
            rest[np.flatnonzero(kicks)] = victims
            mark, at = rest[~fits], at[~fits]
            at = self._other(mark, at)
        return not len(mark)

    def delete(self, keys: np.ndarray) -> None:
        """Takes one mark of each key out; the keys must be in."""
        mark, at = self._places(keys)
        for m, a, b in zip(mark, at, self._other(mark, at)):
            bucket = a if (self.cells[a] == m).any() else b
            slot = np.flatnonzero(self.cells[bucket] == m)
            if len(slot):
                last = self.used[bucket] - 1
                self.cells[bucket, slot[0]], self.cells[bucket, last] = self.cells[bucket, last], 0
                self.used[bucket] = last


def build(keys: np.ndarray, buckets: int = 16) -> CuckooFilter:
    """A filter of distinct keys, as large as it must be."""
    while LOAD * buckets * SLOTS < len(keys):
        buckets *= 2
    while not (made := CuckooFilter(buckets)).insert(keys):
        buckets *= 2
    return made


class Screen:
    """A filter that grows with what it sees, from the keys that it has taken."""

    def __init__(self):
        self.filter, self.keys = CuckooFilter(), [np.zeros(0, np.int64)]

    def add(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(new, hits), each key once; a key with several rows in keys is both."""
        one, n = np.unique(keys, return_counts=True)
        there = self.filter.contains(one)
        new, hits = one[~there], one[there | (n > 1)]
        self.keys.append(new)
        if not self.filter.insert(new):
            stored = np.concatenate(self.keys)
            self.filter, self.keys = build(stored, 2 * len(self.filter.cells)), [stored]
        return new, hits


def described(bits: int):
    """A column function: digest (64 bits, of which the upper `bits` count), n_points and text_sha256 of a text."""
    keep = (2**64 - 1) ^ (2 ** (64 - bits) - 1)

    @F.arrow_udf("digest long, n_points long, text_sha256 string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        common.settle()
        for texts in batches:
            points = pc.utf8_length(texts).cast(pa.int64())
            digests, names = np.empty(len(texts), np.uint64), []
            for i, s in enumerate(texts.cast(pa.binary())):
                norm = s.as_py().translate(None, BLANK)
                digests[i] = xxhash.xxh64_intdigest(norm) & keep
                names.append(hashlib.sha256(norm).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(digests.view(np.int64)), points, pa.array(names, pa.string())], names=["digest", "n_points", "text_sha256"])
        common.trim()

    return run


def _pairs(digests: np.ndarray, again: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(np.full(len(digests), again))], names=["digest", "again"])


def _thinned(digests: DataFrame) -> DataFrame:
    """(digest, again): in each task a digest comes once as new and, if it comes again, once as a hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        screen, said = Screen(), np.zeros(0, np.int64)
        for b in batches:
            new, hits = screen.add(np.array(b.column(0), np.int64))
            yield _pairs(new, False)
            hits = np.setdiff1d(hits, said, assume_unique=True)
            said = np.union1d(said, hits)
            yield _pairs(hits, True)

    return digests.mapInArrow(common.lean(run), "digest long, again boolean")


def _by_shard(rows: DataFrame, filters: DataFrame | None, step, schema: str, order: tuple[str, ...] = ("digest",)) -> DataFrame:
    """step(shard, filter bytes or None, digests, flags of a batch, state) over the rows (shard, digest, again) of each shard, in batches; state is a dict per shard; at a shard's
    end step is called with digests None. filters: (shard, cells)."""
    x = rows.select("shard", "digest", "again", F.lit(None).cast("binary").alias("cells"))
    if filters is not None:
        x = x.unionByName(filters.select("shard", F.lit(None).cast("long").alias("digest"), F.lit(None).cast("boolean").alias("again"), "cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cells, state = None, None, {}
        for b in batches:
            shards = np.array(b.column(0), np.int64)
            edges = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
            for lo, hi in zip(edges, edges[1:]):
                if hi == lo:
                    continue
                if shards[lo] != now:
                    if now is not None:
                        yield from step(now, cells, None, None, state)
                    now, cells, state = int(shards[lo]), None, {}
                part = b.slice(lo, hi - lo)
                if part.column(3).null_count < len(part):
                    at = part.column(3).is_valid().index(True).as_py()
                    cells = part.column(3)[at].as_py()
                part = part.filter(part.column(1).is_valid())
                if part.num_rows:
                    yield from step(now, cells, np.array(part.column(1), np.int64), np.array(part.column(2).fill_null(False)), state)
        if now is not None:
            yield from step(now, cells, None, None, state)

    dealt = x.repartition("shard").sortWithinPartitions("shard", F.col("cells").isNull(), *order)
    return dealt.select("shard", "digest", "again", "cells").mapInArrow(common.lean(run), schema)


class Index:
    """Live documents (members), the filters of their digests and the texts found equal, in versions of tables under `path` in the shared folder."""

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int = SHARDS, bits: int = 64):
        if shards & (shards - 1):
            raise ValueError("shards: a power of two")
        self.spark, self.shards, self.bits = spark, shards, bits
        self.path = path or f"{common.shared_dir(spark)}/cuckoo-{uuid.uuid4().hex}"
        common.registered(self.path)
        self.parts: dict[str, list[str]] = {"added": [], "gone": [], "equal": []}
        self.filters: DataFrame | None = None

    def _write(self, df: DataFrame, kind: str) -> DataFrame:
        to = f"{self.path}/{kind}-{uuid.uuid4().hex}"
        common.write(df, to)
        self.parts.get(kind, []).append(to)
        return self.spark.read.schema(df.schema).parquet(to)

    def _all(self, kind: str, schema: str) -> DataFrame:
        paths = self.parts[kind]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def members(self) -> DataFrame:
        """The live documents."""
        added = self._all("added", MEMBER)
        return added.join(self._all("gone", "row long"), "row", "left_anti") if self.parts["gone"] else added

    def _shard(self):
        low = (self.shards - 1).bit_length()
        return F.shiftrightunsigned("digest", 64 - low).cast("int") if low else F.lit(0)

    def insert(self, docs: DataFrame) -> "Index":
        """Add documents (doc_id, text)."""
        ident = described(self.bits)
        texts = docs.select(F.col("doc_id").cast("long"), common.empty_text().alias("text"))
        version = len(self.parts["added"])
        keyed = texts.select((F.monotonically_increasing_id() + (version << BATCH)).alias("row"), "doc_id", ident("text").alias("k"))
        new = self._write(keyed.select("row", "doc_id", "k.n_points", "k.digest", "k.text_sha256").withColumn("shard", self._shard()), "added")
        screened = self._write(self._screened(new), "screened")
        hits = screened.where("hit").select("digest").distinct()
        hits = self._write(hits, "hits")
        self._write(self._equal(hits, texts, ident), "equal")
        # What a filter took for known and no member has is new after all.
        fresh = screened.where("not hit").select("digest")
        if version:
            before = self._all("added", MEMBER).where(F.col("row") < version << BATCH)
            before = before.join(self._all("gone", "row long"), "row", "left_anti") if self.parts["gone"] else before
            known = common.some_of(before.select("digest"), hits, "digest").distinct()
        else:
            known = None
        maybe = hits.join(known, "digest", "left_anti") if known is not None else hits
        self._store(fresh.unionByName(maybe).distinct())
        return self

    def _screened(self, new: DataFrame) -> DataFrame:
        """(digest, hit): digests that are new to the filters, and those that are not or come again in this batch."""

        def step(shard, cells, digests, again, state):
            if digests is None:
                return
            if "screen" not in state:
                state["screen"], state["old"] = Screen(), CuckooFilter(cells=cells) if cells else None
            if state["old"] is not None:
                old = state["old"].contains(digests)
                yield _hits(np.unique(digests[old]), True)
                digests, again = digests[~old], again[~old]
            first, hits = state["screen"].add(digests[~again])
            yield _hits(first, False)
            yield _hits(np.union1d(hits, digests[again]), True)

        thin = _thinned(new.select("digest")).withColumn("shard", self._shard())
        return _by_shard(thin, self.filters, step, "digest long, hit boolean")

    def _equal(self, hits: DataFrame, texts: DataFrame, ident) -> DataFrame:
        """(digest, sha): the unlike texts of the hits, compared by their bytes, those of earlier members by their SHA-256."""
        some = common.some_of(texts.select("text", ident("text").alias("k")).select("text", "k.*"), hits, "digest")
        found = bodies.packed(some.select(F.col("digest").alias("key"), F.col("text_sha256").alias("sha"), "text"), _bare)
        return bodies.confirmed(found).select(F.col("key").alias("digest"), F.col("sha").alias("text_sha256"))

    def _store(self, digests: DataFrame, delete: bool = False) -> None:
        """The filters with the digests (each once) in, or out."""

        def step(shard, cells, keys, again, state):
            if keys is not None:
                state.setdefault("keys", []).append(keys)
                return
            keys = np.concatenate(state.get("keys", [np.zeros(0, np.int64)]))
            if delete:
                old = CuckooFilter(cells=cells)
                old.delete(keys)
            elif cells is None:
                old = build(keys)
            else:
                old = CuckooFilter(cells=cells)
                if not old.insert(keys):
                    old = None  # full: to be built anew from the stored keys
            yield _blob(shard, old)

        rows = digests.withColumn("shard", self._shard()).withColumn("again", F.lit(False))
        made = self._write(_by_shard(rows, self.filters, step, "shard int, cells binary"), "filters")
        full = made.where("cells is null").select("shard")
        if full.head(1):
            stored = self.members().join(F.broadcast(full), "shard").select("shard", "digest").distinct().withColumn("again", F.lit(False))

            def rebuilt(shard, cells, keys, again, state):
                if keys is not None:
                    state.setdefault("keys", []).append(keys)
                    return
                yield _blob(shard, build(np.concatenate(state["keys"])))

            made = self._write(made.where("cells is not null").unionByName(_by_shard(stored, None, rebuilt, "shard int, cells binary")), "filters")
        self.filters = made

    def delete(self, doc_ids: DataFrame) -> "Index":
        """Take the documents with these doc_id out."""
        before = self.members()
        gone = self._write(before.join(doc_ids.select(F.col("doc_id").cast("long")).distinct(), "doc_id", "left_semi").select("row", "digest"), "leaving")
        self._write(gone.select("row"), "gone")
        dead = gone.select("digest").distinct().join(self.members().select("digest").distinct(), "digest", "left_anti")
        self._store(self._write(dead, "dead"), delete=True)
        return self

    def report(self) -> DataFrame:
        """row by row: doc_id, keep_id, group_size, kept, text_sha256 of the live documents."""
        rows = self.members()
        equal = self._write(self._all("equal", "digest long, text_sha256 string").distinct(), "classes")
        some = common.some_of(rows, equal.select("digest").distinct(), "digest")
        best = F.max_by(F.struct("doc_id", "row"), F.struct("n_points", F.col("doc_id").isNotNull(), F.bitwise_not("doc_id"), F.bitwise_not("row")))
        groups = some.groupBy("digest", "text_sha256").agg(F.count(F.lit(1)).alias("n"), best.alias("best")).join(equal, ["digest", "text_sha256"])
        groups = self._write(groups.where("n > 1").select("digest", "text_sha256", "n", F.col("best.doc_id").alias("keep"), F.col("best.row").alias("keep_row")), "groups")
        x = rows.join(groups, ["digest", "text_sha256"], "left")
        alone = F.col("keep_row").isNull()
        return x.select(
            "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256"
        )


def _bare(text: bytes) -> bytes:
    return text.translate(None, BLANK)


def _hits(digests: np.ndarray, hit: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(np.full(len(digests), hit))], names=["digest", "hit"])


def _blob(shard: int, made: CuckooFilter | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([made.cells.tobytes() if made else None], pa.binary())], names=["shard", "cells"])


def duplicates(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of each document: all are inserted in an index of their own."""
    return Index(docs.sparkSession, bits=bits).insert(docs).report()


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, length(text) AS points, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS norm FROM t)
SELECT doc_id, first(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)
"""
