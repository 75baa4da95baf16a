"""Streaming forms: windowed rates with watermarks, and thinning of log streams with state per key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def json_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def parquet_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_rate(stream: DataFrame, width: str, seconds: int, late: str, labels: list[str]) -> DataFrame:
    """(start, labels, rate): events per second in each window; a window is final once the watermark, `late` behind, has passed it."""
    w = stream.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), *labels)
    return w.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *labels, (F.col("n") / float(seconds)).alias("rate"))


def sessions(stream: DataFrame, gap: str, late: str, labels: list[str]) -> DataFrame:
    """(begins, ends, labels, n) of sessions without a pause of `gap`."""
    w = stream.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), *labels)
    return w.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("begins"), F.col("w.end").alias("ends"), *labels, "n")


def _stateful(stream: DataFrame, keys: list[str], state: str, keep) -> DataFrame:
    """Rows that keep(times, state) marks; keep gives the marks and the new state."""
    schema = stream.schema

    def run(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values("ts", kind="stable")
        times = rows["ts"].astype("int64").to_numpy() / (1e9 if str(rows["ts"].dtype).startswith("datetime64[ns") else 1e6)
        marks, now = keep(times, held.get if held.exists else None)
        held.update(now)
        yield rows[marks][[f.name for f in schema]]

    return stream.groupBy(*keys).applyInPandasWithState(run, schema, state, "append", GroupStateTimeout.NoTimeout)


def drop_repeats(stream: DataFrame, ttl: float, keys: list[str]) -> DataFrame:
    """Drops a row if less than ttl seconds have passed since the last kept one of its key. Rows of a batch are taken in time order."""

    def keep(times, state):
        last, marks = (state[0] if state else None), []
        for t in times:
            marks.append(last is None or t - last >= ttl)
            last = t if marks[-1] else last
        return marks, (float(last),)

    return _stateful(stream, keys, "last double", keep)


def limit_rate(stream: DataFrame, window: float, most: int, keys: list[str]) -> DataFrame:
    """Keeps `most` rows per window of a key; the next window opens once more than `window` seconds have passed."""

    def keep(times, state):
        (start, n), marks = state or (None, 0), []
        for t in times:
            if start is None or t - start > window:
                start, n = t, 0
            n += 1
            marks.append(n <= most)
        return marks, (float(start), int(n))

    return _stateful(stream, keys, "start double, n long", keep)


def every_nth(stream: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """Keeps every n-th row of a key."""

    def keep(times, state):
        seen = state[0] if state else 0
        marks = [(seen + i + 1) % n == 0 for i in range(len(times))]
        return marks, (int(seen + len(times)),)

    return _stateful(stream, keys, "seen long", keep)
