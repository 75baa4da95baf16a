"""Which encoding bytes are in, by state checks and by byte pairs that a table of texts teaches.

fit() counts, over all rows of a table, the pairs of neighbouring bytes with one beyond ASCII, as each single-byte encoding writes the texts. What is
brought to the driver and shipped to tasks is one table of 65,536 numbers per encoding, whatever the number of rows.

detect() decides in order: a byte order mark; valid UTF-8; the zero bytes of UTF-16 and UTF-32, if the whole decodes; else the single-byte encoding under which the pairs are likeliest. The
confidence of the last is that encoding's share of the likelihood, so short contents are less sure than long ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SINGLE = ("cp1252", "cp850", "mac-roman")
MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe\x00\x00", "utf-32-le"), (b"\x00\x00\xfe\xff", "utf-32-be"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))
PAIRS = 1 << 16
#: What a pair that was never seen counts; the most that a guess is sure of.
UNSEEN, SURE = 0.01, 0.99
#: Zero bytes that the high halves of UTF-16 text in these languages have at least, and the low halves at most.
MANY, FEW = 0.5, 0.05


def pairs(content: bytes) -> np.ndarray:
    """The pairs of neighbouring bytes, one at least beyond ASCII, as numbers; a lone last or first byte is paired with a blank."""
    b = np.frombuffer(b" " + content + b" ", np.uint8).astype(np.int64)
    return (b[:-1] * 256 + b[1:])[(b[:-1] >= 128) | (b[1:] >= 128)]


def fit(texts: DataFrame, encodings: tuple[str, ...] = SINGLE) -> dict[str, np.ndarray]:
    """The logarithms of the pairs' shares for each encoding, from texts (text). Characters that an encoding lacks are left out; a table without any teaches nothing, and all encodings are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(encodings), PAIRS), np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                if text and not text.isascii():
                    for i, e in enumerate(encodings):
                        total[i] += np.bincount(pairs(text.encode(e, "ignore")), minlength=PAIRS)
        e, p = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(e, pa.int32()), pa.array(p, pa.int32()), pa.array(total[e, p], pa.int64())], names=["e", "pair", "n"])

    counts = np.full((len(encodings), PAIRS), UNSEEN)
    for r in texts.select("text").mapInArrow(run, "e int, pair int, n long").groupBy("e", "pair").agg(F.sum("n").alias("n")).collect():  # encodings x 65,536 rows at most
        counts[r.e, r.pair] += r.n
    return {e: np.log(counts[i] / counts[i].sum()) for i, e in enumerate(encodings)}


def _decodes(content: bytes, encoding: str) -> bool:
    try:
        content.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def guess(content: bytes, model: dict[str, np.ndarray]) -> tuple[str, float, bool]:
    """(encoding, confidence, whether a byte order mark says so). Empty and ASCII contents are UTF-8."""
    for mark, name in MARKS:
        if content.startswith(mark) and _decodes(content[len(mark) :], name):
            return name, 1.0, True
    zeros = np.frombuffer(content, np.uint8) == 0
    if zeros.any():
        n = len(content)
        if n % 4 == 0:
            share = [float(zeros[i::4].mean()) for i in range(4)]
            for name, high in (("utf-32-le", (2, 3)), ("utf-32-be", (0, 1))):
                if min(share[i] for i in high) > 0.9 and _decodes(content, name):
                    return name, round(min(SURE, min(share[i] for i in high)), 3), False
        if n % 2 == 0:
            even, odd = float(zeros[0::2].mean()), float(zeros[1::2].mean())
            for name, high, low in (("utf-16-le", odd, even), ("utf-16-be", even, odd)):
                if high >= MANY and low <= FEW and _decodes(content, name):
                    return name, round(min(SURE, high), 3), False
    if _decodes(content, "utf-8"):
        return "utf-8", 1.0 if not content.isascii() else SURE, False
    seen = pairs(content)
    score = {e: float(t[seen].sum()) for e, t in model.items()}
    best = max(score, key=lambda e: score[e])
    return best, round(min(SURE, 1 / sum(np.exp(max(-700.0, s - score[best])) for s in score.values())), 3), False


def detect(content: Column, model: dict[str, np.ndarray], spark) -> Column:
    """struct(encoding, confidence, bom) of a binary column; null of null."""
    shipped = spark.sparkContext.broadcast(model)

    @F.arrow_udf("encoding string, confidence double, bom boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            found = [guess(c, shipped.value) if c is not None else (None, None, None) for c in b.to_pylist()]
            cols = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.StructArray.from_arrays(cols, names=["encoding", "confidence", "bom"])

    return run(content)


def decoded(df: DataFrame, content: str, encoding: str, strict: bool = False) -> DataFrame:
    """df with `text` and `error`: the content in the named encoding, without a mark. Bytes that do not fit become U+FFFD or, if strict, the text is null and the error says where."""

    @F.arrow_udf("text string, error string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for b, e in batches:
            texts, errors = [], []
            for c, name in zip(b.to_pylist(), e.to_pylist()):
                try:
                    texts.append(None if c is None or name is None else c.decode(name, "strict" if strict else "replace").removeprefix("﻿"))
                    errors.append(None)
                except (UnicodeDecodeError, LookupError) as x:
                    texts.append(None)
                    errors.append(f"{type(x).__name__}: {x}")
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=["text", "error"])

    return df.withColumn("__d", run(F.col(content), F.col(encoding))).select(*[c for c in df.columns if c not in ("text", "error")], "__d.text", "__d.error")
