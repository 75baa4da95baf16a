"""Whole texts as proof: texts that share a key are compared by their bytes, bucketed by the key.

Copies inside a task are shipped once, and then meet in two levels (first salted by task), so a text that
many tasks hold is never gathered in one of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import lean, slices

SALTS = 32


def packed(texts: DataFrame, change: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """(key, sha, z) of texts (key long, sha string, text): each (key, sha) of a task once, z its text, changed and compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, str]] = set()
        pack = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for b in slices(whole, "t"):
                new = [i for i, x in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())) if x not in seen and not seen.add(x)]
                b = b.take(pa.array(new, pa.int64()))
                z = [pack(change(x) if change else x) for x in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(z, pa.binary())], names=["key", "sha", "z"])

    return texts.select("key", "sha", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("t")).mapInArrow(lean(run), "key long, sha string, z binary")


def _merged(found: DataFrame) -> DataFrame:
    """Of neighbours with one (key, sha) the first, once their texts have been compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, body = None, b""
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for b in slices(whole, "z"):
                first = []
                for i, (key, sha, z) in enumerate(zip(*(c.to_pylist() for c in b.columns))):
                    if (key, sha) != now:
                        now, body = (key, sha), z
                        first.append(i)
                    elif z != body and unpack(z) != unpack(body):
                        raise ValueError(f"two texts with one SHA-256: {sha}")
                yield b.take(pa.array(first, pa.int64()))

    return found.mapInArrow(lean(run), "key long, sha string, z binary")


def confirmed(found: DataFrame) -> DataFrame:
    """(key, sha), each once: the unlike texts of each key among found (key, sha, z), told apart by their bytes."""
    salted = found.withColumn("s", F.spark_partition_id() % SALTS)
    one = _merged(salted.repartition("key", "s").sortWithinPartitions("key", "sha").select("key", "sha", "z"))
    return _merged(one.repartition("key").sortWithinPartitions("key", "sha")).select("key", "sha")
