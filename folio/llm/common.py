"""Shared pieces: the shared folder, Arrow batches as byte arrays, worker caches."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import tempfile
import threading
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where unset, a new one, but only if all runs in this machine's one process (tests)."""
    sc = spark.sparkContext
    there = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if there:
        return there.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="folio-"))
    return sc.getCheckpointDir().rstrip("/")


@contextlib.contextmanager
def small_batches(spark: SparkSession, most: int = 8 << 20):
    """While a write runs, Arrow batches to Python hold `most` bytes: they lie in memory twice, in the executor and in its worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, was) if was is not None else spark.conf.unset(key)


#: What the driver's threads have written inside scratch(), by thread.
_written: dict[int, list[str]] = {}


def delete(spark: SparkSession, path: str) -> None:
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    to.getFileSystem(spark._jsc.hadoopConfiguration()).delete(to, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """What materialize() writes inside is deleted at the end; results that read it must be written by then."""
    me = threading.get_ident()
    before = _written.get(me)
    paths = _written[me] = []
    try:
        yield
    finally:
        _written.pop(me) if before is None else _written.update({me: before})
        for path in paths:
            delete(spark, path)


def registered(path: str) -> str:
    """path, which scratch() deletes at its end."""
    _written.get(threading.get_ident(), []).append(path)
    return path


def write(df: DataFrame, to: str) -> None:
    with small_batches(df.sparkSession):
        df.write.option("compression", "zstd").parquet(to)


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Cut the lineage: write df once to the shared folder and read it back."""
    spark = df.sparkSession
    to = registered(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    write(df, to)
    return spark.read.schema(df.schema).parquet(to)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    mod = sys.modules.setdefault("_folio_cache", types.ModuleType("_folio_cache"))
    return mod.__dict__.setdefault("items", {})


def settle() -> None:
    """Make this Python worker, which Spark shares among tasks of one application, give memory back: Arrow's own pool and malloc keep what they once had, and idle workers keep it beside the executor's heap."""
    if "settled" not in worker_cache():
        worker_cache()["settled"] = True
        pa.set_memory_pool(pa.system_memory_pool())
        with contextlib.suppress(OSError, AttributeError):  # not glibc
            ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD: larger blocks go back to the system when freed


def trim() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run):
    """run, a function of Arrow batches, in a worker that gives back the memory it does not use."""

    def wrapped(batches):
        settle()
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def flat_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, n + 1 offsets) of a string or binary array without copying; nulls count as empty."""
    if pa.types.is_string(col.type):
        col = col.cast(pa.binary())
    if col.null_count:
        col = col.fill_null(b"")
    wide = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, wide)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `most` bytes of the column (one row at least), to bound a worker's memory."""
    if not batch.num_rows:
        return
    _, off = flat_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def empty_text(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


_M1, _M2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i < n."""
    cache = worker_cache()
    have = cache.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        have = cache["powers"] = tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_BASE, inverse))
    return have


def range_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of raw[start:end], which depend on nothing but these bytes. start ascends; ranges are not nested."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        lo = int(start[at])
        to = max(at + 1, int(np.searchsorted(end, lo + PIECE, "right")))
        hi = int(end[to - 1])
        up, down = _powers(hi - lo + 1)
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = 0
        np.cumsum((raw[lo:hi].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=sums[1:])
        s, e = start[at:to] - lo, end[at:to] - lo
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + mix((e - s).astype(np.uint64)))
        at = to
    return out


def words_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document, hash) of the words `[^\\x20\\x09-\\x0D]+` of documents raw[off[i]:off[i+1]]; A-Z count as a-z."""
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    inside = np.ones(256, bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 0x20
    is_word = inside[raw]
    before, after = np.append(False, is_word[:-1]), np.append(is_word[1:], False)
    edges = off[(off > 0) & (off < n)]
    before[edges] = False
    after[edges - 1] = False
    start, end = np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1
    return start, end, np.searchsorted(off, start, "right") - 1, range_hashes(lower[raw], start, end)


def zip_texts(docs: DataFrame, key: str = "th", text: str = "text") -> DataFrame:
    """(th, z): the distinct texts of each task, compressed; key is a hash of the text. Other tasks may give a text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        pack = zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for b in slices(whole, "t"):
                new = [i for i, x in enumerate(b.column(0).to_pylist()) if x not in seen and not seen.add(x)]
                b = b.take(pa.array(new, pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([pack(x) for x in b.column(1).to_pylist()], pa.binary())], names=["th", "z"])

    return docs.select(F.col(key).alias("th"), F.col(text).cast("binary").alias("t")).mapInArrow(lean(run), "th long, z binary")


def some_of(df: DataFrame, keys: DataFrame, on: str, most: int = 2_000_000) -> DataFrame:
    """The rows of df whose `on` is in keys (distinct): broadcast up to `most` keys of 8 bytes, joined beyond."""
    return df.join(F.broadcast(keys) if keys.count() <= most else keys, on, "left_semi")
