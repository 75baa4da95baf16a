"""Language identification by compression.

Each language has a dictionary: whole texts of a bounded, hashed sample of its labelled rows. A text is
compressed with every dictionary (zstandard, raw content) in blocks, so that long texts do not drown the
dictionary in what they teach the compressor themselves; the smallest total names the language. A margin
to the second smallest below `min_margin` marks the row as rejected; the best guess stays.

Defined results: null text or text without a letter is `und` with score 0; so is everything when nothing was
learned; with one learned language the score is 1; ties go to the language with more labelled rows; equal texts have
equal results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import common

NONE = "und"
#: Punctuation, digits and case tell little about a language: all blank, letters in lower case.
PLAIN = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 0x20 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
#: Nothing larger is shipped to executors: many languages share it.
MOST_DICTIONARY_BYTES = 16 << 20


def learn(labelled: DataFrame, dict_bytes: int = 96 << 10, rows: int = 512) -> dict[str, bytes]:
    """lang -> dictionary from labelled (doc_id, text, lang), the most frequent language first.

    The sample, which is all that is bounded: per language at most `rows` rows of least hash, taken while the bytes before them stay under dict_bytes;
    a dictionary is the end of these texts, 2 * dict_bytes at most, and all together MOST_DICTIONARY_BYTES, of which each language gets an equal share.
    A language's row count says below which hash about 4 * rows of its rows lie; only these are ranked, by identifier
    and size alone. The texts of the chosen are fetched by a join with at most rows * languages ids.
    """
    some = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = labelled.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return {}
    part = F.create_map(*[x for r in counts for x in (F.lit(r.lang), F.lit(min(1.0, 4 * rows / r.n)))])
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    narrow = some.select("doc_id", "lang", F.octet_length("text").alias("n"), h.alias("h")).where(F.col("h") <= part[F.col("lang")] * float(1 << 30))
    w = Window.partitionBy("lang").orderBy("h", "doc_id", "n")
    few = narrow.withColumn("r", F.row_number().over(w)).where(F.col("r") <= rows)
    few = few.withColumn("before", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1))).where(F.coalesce("before", F.lit(0)) < dict_bytes)
    ids = few.select("doc_id", "lang").distinct()
    texts = some.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    found: dict[str, list[bytes]] = {}
    for r in sorted(texts.collect(), key=lambda r: (r.lang, r.doc_id is None, r.doc_id)):
        found.setdefault(r.lang, []).append(r.text.lower().encode("utf-8", "replace").translate(PLAIN))
    share = min(2 * dict_bytes, MOST_DICTIONARY_BYTES // max(1, len(found)))
    often = {r.lang: r.n for r in counts}
    return {k: b" ".join(v)[-share:] for k, v in sorted(found.items(), key=lambda x: (-often[x[0]], x[0]))}


class Model:
    def __init__(self, dictionaries: dict[str, bytes], level: int = 9, block: int = 1024, sharpness: float = 8.0):
        self.names, self.block, self.sharpness = list(dictionaries), block, sharpness
        self.packers = []
        for data in dictionaries.values():
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.packers.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_dict_id=False).compress)

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode("utf-8", "replace").translate(PLAIN)
        parts = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        return [sum([len(pack(p)) for p in parts]) for pack in self.packers]

    def predict(self, text: str) -> tuple[str, float, float]:
        """(language, score, margin)"""
        if len(self.names) < 2:
            return self.names[0] if self.names else NONE, float(bool(self.names)), 1.0
        got = self.sizes(text)
        best = min(range(len(got)), key=got.__getitem__)
        second = min(x for i, x in enumerate(got) if i != best)
        bits = (np.array(got) - got[best]) * 8.0 / len(text.encode("utf-8", "replace"))
        return self.names[best], float(1.0 / np.exp(-self.sharpness * bits).sum()), (second - got[best]) / max(second, 1)


def predict(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", min_margin: float = 0.02) -> DataFrame:
    """docs with lang_pred, score and rejected (replacing columns of these names)."""
    shipped = docs.sparkSession.sparkContext.broadcast(dictionaries)
    names = ["lang_pred", "score", "rejected"]
    kept = [c for c in docs.columns if c not in names]
    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema), "lang_pred string", "score double", "rejected boolean"]
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shipped.value)
        for whole in batches:
            for b in common.slices(whole, "__text"):
                got = [model.predict(t) if t is not None else (NONE, 0.0, 1.0) for t in b.column(len(kept)).to_pylist()]
                cols = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[0] != NONE and g[2] < min_margin for g in got], pa.bool_())]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], *cols], names=[*kept, *names])

    return docs.select(*kept, F.when(letters, F.col(text)).alias("__text")).mapInArrow(common.lean(run), ", ".join(fields))
