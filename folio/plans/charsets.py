"""The charset query: every document written in one of six encodings and told again. SQL cannot express it; tests compare with a plain version and measure held-out accuracy."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.operators import charset
from folio.plans.registry import query
from folio.plans.views import table

SIX = ("utf-8", "cp1252", "cp850", "mac-roman", "utf-16-le", "utf-32-be")


def written(text: Column, encoding: Column) -> Column:
    """The text in an encoding; characters that it lacks become question marks."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, names in batches:
            yield pa.array([t.encode(n, "replace") for t, n in zip(texts.to_pylist(), names.to_pylist())], pa.binary())

    return run(text, encoding)


@query()
def charset_detect(spark, d):
    """Learnt from the documents of folds other than 0 of crc32(doc_id) mod 5; told for all."""
    x = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = charset.fit(x.where(fold != 0))
    name = F.get(F.array(*map(F.lit, SIX)), (F.abs(F.xxhash64("doc_id")) % 6).cast("int"))
    x = x.select("doc_id", (fold == 0).alias("held_out"), name.alias("written"), written(F.col("text"), name).alias("content"))
    return x.select("doc_id", "held_out", "written", charset.detect(F.col("content"), model, spark).alias("k")).select("doc_id", "held_out", "written", "k.encoding", "k.confidence", "k.bom")
