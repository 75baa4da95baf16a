"""Instant vectors of raw samples: one value per series and evaluation, aligned in time, matched by labels.

Samples are rows (ts, label columns, value), scraped whenever each series was; a vector has (labels, t, value) at whole multiples of a step. No
window runs over the samples of a series: they are brought to steps by aggregation first.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators import metrics


def selected(samples: DataFrame, *where: Column) -> DataFrame:
    return functools.reduce(DataFrame.where, where, samples)


def instant(samples: DataFrame, labels: list[str], step: int, lookback: int, ts: str = "ts") -> DataFrame:
    """At each t the last sample of the `lookback` seconds up to it (at one time the largest); no row where there is none. `step` divides `lookback`.

    The last sample of a step is what the steps after it may see, so each goes to lookback / step evaluations, of which the latest wins."""
    s = samples.select(*labels, F.unix_micros(F.col(ts).cast("timestamp")).alias("__s"), "value")
    s = s.withColumn("t", (F.ceil(F.col("__s") / 1e6 / step) * step).cast("long"))
    last = s.groupBy(*labels, "t").agg(F.max(F.struct("__s", "value")).alias("v"))
    seen = last.select(*labels, "v", F.explode(F.sequence(F.col("t"), F.col("t") + (lookback - step), F.lit(step).cast("long"))).alias("t"))
    # The step that the look-back cuts: its last sample may lie before the cut.
    seen = seen.where(F.col("v.__s") > (F.col("t") - lookback) * 1_000_000)
    return seen.groupBy(*labels, "t").agg(F.max("v").alias("v")).select(*labels, "t", F.col("v.value").alias("value"))


def rate(samples: DataFrame, labels: list[str], seconds: int, step: int) -> DataFrame:
    """Per second what a counter added in the `seconds` up to each t, as long as there are two samples in them."""
    return metrics.sliding_increase(samples, labels, seconds, step, beyond=seconds - step).select(*labels, "t", F.col("rate").alias("value"))


def average(samples: DataFrame, labels: list[str], seconds: int, step: int) -> DataFrame:
    return metrics.sliding_average(samples, labels, seconds, step, beyond=seconds - step).withColumnRenamed("average", "value")


def total(v: DataFrame, by: list[str]) -> DataFrame:
    return v.groupBy(*by, "t").agg(F.sum("value").alias("value"))


def mean(v: DataFrame, by: list[str]) -> DataFrame:
    return v.groupBy(*by, "t").agg(F.avg("value").alias("value"))


def changed(v: DataFrame, f: Callable[[Column], Column]) -> DataFrame:
    return v.withColumn("value", f(F.col("value")))


def matched(left: DataFrame, right: DataFrame, labels: list[str], op: str) -> DataFrame:
    """left op right where both have the labels at the time. x / 0 is infinite, 0 / 0 not a number, which no comparison holds for."""
    r = right.select(*labels, "t", F.col("value").alias("__by"))
    a, b = F.col("value"), F.col("__by")
    infinite = F.when(a > 0, float("inf")).when(a < 0, float("-inf")).otherwise(float("nan"))
    value = {"/": F.when(b == 0, infinite).otherwise(F.try_divide(a, b)), "+": a + b, "-": a - b, "*": a * b}[op]
    return left.join(r, [*labels, "t"]).select(*labels, "t", value.alias("value"))


def bucket_quantile(v: DataFrame, q: float, labels: list[str]) -> DataFrame:
    """Of rates of cumulative buckets (labels, le, t, value): the quantile by linear steps within the bucket that reaches it."""
    return metrics.quantile(v.withColumnRenamed("value", "n"), q, [*labels, "t"]).withColumnRenamed("quantile", "value")
