"""Metric samples: rates, histograms and their quantiles, ratios, burn rates, alerts.

Samples are rows (ts, label columns, value). Windows are aligned buckets of event time, or (sliding_...) the time up to each step of a grid; a rate in
buckets is what was added per second, a sliding one is extrapolated to the window's edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucketed(samples: DataFrame, width: str, ts: str = "ts") -> DataFrame:
    """samples with `start`, the beginning of their bucket."""
    return samples.withColumn("start", F.window(ts, width)["start"])


def event_rate(samples: DataFrame, width: str, seconds: int, labels: list[str]) -> DataFrame:
    """Events per second in each bucket."""
    return bucketed(samples, width).groupBy("start", *labels).agg((F.count(F.lit(1)) / float(seconds)).alias("rate"))


def _gain(value: Column, last: Column) -> Column:
    """What a counter added since its last value: a lower value is a reset and counts whole."""
    return F.when(last.isNull(), 0.0).when(value < last, value).otherwise(value - last).cast("double")


def _steps(samples: DataFrame, labels: list[str], bucket: str, order: list[str]) -> DataFrame:
    """A row per (labels, bucket) of counter samples: n, a, b (first and last of order[0]), added within, `across` (since the bucket before) and f, the first value.

    Samples are sorted within their bucket only; the windows over labels hold a row per bucket."""
    within = Window.partitionBy(*labels, bucket).orderBy(*order)
    x = samples.withColumn("__gain", _gain(F.col("value"), F.lag("value").over(within)))
    at = F.struct(*order)
    g = x.groupBy(*labels, bucket).agg(
        F.count(F.lit(1)).alias("n"), F.min(order[0]).alias("a"), F.max(order[0]).alias("b"), F.sum("__gain").alias("added"), F.min_by("value", at).alias("f"), F.max_by("value", at).alias("__l")
    )
    return g.withColumn("across", _gain(F.col("f"), F.lag("__l").over(Window.partitionBy(*labels).orderBy(bucket)))).drop("__l")


def counter_increase(samples: DataFrame, labels: list[str], width: str, ts: str = "ts") -> DataFrame:
    """(start, labels, increase) of counters: a value below the last one is a reset and counts whole."""
    g = _steps(bucketed(samples, width, ts), labels, "start", [ts, "value"])
    return g.select("start", *labels, (F.col("added") + F.col("across")).alias("increase"))


def histogram(samples: DataFrame, bounds: tuple, labels: list[str], value: str = "value") -> DataFrame:
    """(labels, le, n): how many values are at most each bound, and all (le infinite). A row meets each bound in one aggregation, without exploding."""
    counts = [F.count_if(F.col(value) <= float(b)).alias(f"b{i}") for i, b in enumerate(bounds)] + [F.count(value).alias("all")]
    g = samples.groupBy(*labels).agg(*counts)
    pairs = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)] + [F.struct(F.lit(float("inf")).alias("le"), F.col("all").alias("n"))]
    return g.select(*labels, F.explode(F.array(*pairs)).alias("x")).select(*labels, "x.le", "x.n")


def quantile(buckets: DataFrame, q: float, labels: list[str]) -> DataFrame:
    """(labels, quantile) of cumulative buckets: linear within the first that reaches q of all; the highest finite bound if only the last does."""
    w = Window.partitionBy(*labels)
    by = w.orderBy("le")
    b = buckets.withColumns({"total": F.max("n").over(w), "lo": F.coalesce(F.lag("le").over(by), F.lit(0.0)), "below": F.coalesce(F.lag("n").over(by), F.lit(0))})
    hit = b.where((F.col("total") > 0) & (F.col("n") >= q * F.col("total")))
    value = F.when(F.col("le") == float("inf"), F.col("lo")).otherwise(F.col("lo") + (F.col("le") - F.col("lo")) * (q * F.col("total") - F.col("below")) / (F.col("n") - F.col("below")))
    return hit.groupBy(*labels).agg(F.min_by(value, "le").alias("quantile"))


def rolling(steps: DataFrame, labels: list[str], seconds: int, step: int, *aggregates: Column) -> DataFrame:
    """aggregates (made with OVER) over the rows (t: end of a step of `step` seconds) of the `seconds` up to each t."""
    w = Window.partitionBy(*labels).orderBy("t").rangeBetween(-(seconds - step), 0)
    return steps.select(*labels, "t", *[a(w) for a in aggregates])


def on_grid(steps: DataFrame, labels: list[str], step: int, beyond: int = 0) -> DataFrame:
    """The rows of steps and an empty one for each t between the first and the last of its labels (and `beyond` seconds more) that has none."""
    ends = steps.groupBy(*labels).agg(F.min("t").alias("a"), (F.max("t") + beyond).alias("b"))
    return ends.select(*labels, F.explode(F.sequence("a", "b", F.lit(step).cast("long"))).alias("t")).join(steps, [*labels, "t"], "left")


def _in_steps(samples: DataFrame, step: int, ts: str) -> DataFrame:
    """samples with __s (seconds) and t, the end of their step."""
    s = samples.withColumn("__s", F.unix_micros(F.col(ts).cast("timestamp")) / 1e6)
    return s.withColumn("t", (F.ceil(F.col("__s") / step) * step).cast("long"))


def sliding_increase(samples: DataFrame, labels: list[str], seconds: int, step: int, ts: str = "ts", beyond: int = 0) -> DataFrame:
    """(labels, t, increase, rate) of a counter (ts, labels, value) over the `seconds` up to each t (whole multiples of `step`, which divides `seconds`), up to
    `beyond` seconds after the last step that has samples.

    Within a window: what was added between its samples (a lower value is a reset and counts whole), stretched to the window's edges, but by no more than half a
    mean gap where the edge is farther than 1.1 gaps, and not below a counter of 0. Windows of fewer than two samples have none. Samples are sorted
    within their step, and the windows over labels hold a row per step."""
    s = _in_steps(samples.select(*labels, F.col(ts).alias("__ts"), "value"), step, "__ts").select(*labels, "t", "__s", "value")
    steps = _steps(s, labels, "t", ["__s", "value"]).withColumns({"f": F.struct(F.col("across"), F.col("f").alias("value")), "added": F.col("added") + F.col("across")}).drop("across")
    r = rolling(
        on_grid(steps, labels, step, beyond), labels, seconds, step, lambda w: F.sum("n").over(w).alias("n"), lambda w: F.sum("added").over(w).alias("added"), lambda w: F.min("a").over(w).alias("a"),
        lambda w: F.max("b").over(w).alias("b"), lambda w: F.first("f", ignorenulls=True).over(w).alias("f"),
    ).where("n >= 2 and b > a")
    raw, between = F.col("added") - F.col("f.across"), F.col("b") - F.col("a")
    gap = between / (F.col("n") - 1)
    before, after = F.col("a") - (F.col("t") - seconds), F.col("t") - F.col("b")
    near = lambda d: F.when(d >= gap * 1.1, gap / 2).otherwise(d)
    zero = F.when((raw > 0) & (F.col("f.value") >= 0), between * F.col("f.value") / raw)
    increase = raw * (between + F.least(near(before), F.coalesce(zero, near(before))) + near(after)) / between
    return r.select(*labels, "t", increase.alias("increase"), (increase / seconds).alias("rate"))


def sliding_average(samples: DataFrame, labels: list[str], seconds: int, step: int, ts: str = "ts", value: str = "value", beyond: int = 0) -> DataFrame:
    """(labels, t, average) of the samples in the `seconds` up to each t."""
    steps = _in_steps(samples, step, ts).groupBy(*labels, "t").agg(F.count(value).alias("n"), F.sum(F.col(value).cast("double")).alias("v"))
    r = rolling(on_grid(steps, labels, step, beyond), labels, seconds, step, lambda w: F.sum("n").over(w).alias("n"), lambda w: F.sum("v").over(w).alias("v"))
    return r.where("n > 0").select(*labels, "t", (F.col("v") / F.col("n")).alias("average"))


def sliding_quantile(samples: DataFrame, bounds: tuple, labels: list[str], q: float, seconds: int, step: int, ts: str = "ts", value: str = "value") -> DataFrame:
    """(labels, t, quantile) of the histogram of the samples in the `seconds` up to each t."""
    s = samples.withColumn("t", (F.ceil(F.unix_micros(F.col(ts).cast("timestamp")) / 1e6 / step) * step).cast("long"))
    b = histogram(s, bounds, [*labels, "t"], value)
    r = rolling(on_grid(b, [*labels, "le"], step), [*labels, "le"], seconds, step, lambda w: F.sum("n").over(w).alias("n"))
    return quantile(r.where("n is not null"), q, [*labels, "t"])


def ratio(top: DataFrame, bottom: DataFrame, labels: list[str], to: str = "ratio") -> DataFrame:
    """top / bottom (labels, value) where both have the labels and the divisor is not 0."""
    b = bottom.select(*labels, F.col("value").alias("__by")).where("__by <> 0")
    return top.join(b, labels).select(*labels, (F.col("value") / F.col("__by")).alias(to))


def either(left: DataFrame, right: DataFrame, labels: list[str]) -> DataFrame:
    """The left rows, and the right ones whose labels the left does not have."""
    return left.unionByName(right.join(left.select(*labels).distinct(), labels, "left_anti"))


def average_over(samples: DataFrame, width: str, labels: list[str]) -> DataFrame:
    return bucketed(samples, width).groupBy("start", *labels).agg(F.avg("value").alias("average"))


def failure_share(samples: DataFrame, width: str, failed: Column, labels: list[str] | None = None) -> DataFrame:
    """(start, labels, share) of failed samples."""
    return bucketed(samples, width).groupBy("start", *(labels or [])).agg((F.count_if(failed) / F.count(F.lit(1))).alias("share"))


def burn_rate(samples: DataFrame, width: str, failed: Column, budget: float = 0.02) -> DataFrame:
    """How many times faster than allowed the error budget is used."""
    return failure_share(samples, width, failed).select("start", (F.col("share") / budget).alias("burn"))


def alerts(series: DataFrame, condition: Column, hold: int, step: int, labels: list[str], start: str = "start") -> DataFrame:
    """(labels, begins, ends, evaluations) of the stretches of evaluations, `step` seconds apart, at which the condition held for at least `hold`
    seconds. An absent evaluation ends a stretch."""
    w = Window.partitionBy(*labels).orderBy("__t")
    x = series.where(condition).withColumn("__t", F.unix_seconds(F.col(start).cast("timestamp")))
    x = x.withColumn("__new", (F.coalesce(F.col("__t") - F.lag("__t").over(w), F.lit(step + 1)) > step).cast("int")).withColumn("__island", F.sum("__new").over(w))
    g = x.groupBy(*labels, "__island").agg(F.min(start).alias("begins"), F.max(start).alias("ends"), F.count(F.lit(1)).alias("evaluations"), F.min("__t").alias("a"), F.max("__t").alias("b"))
    return g.where(F.col("b") - F.col("a") >= hold).select(*labels, "begins", "ends", "evaluations")


def top(series: DataFrame, k: int, value: str, ties: list[str], per: list[str] | None = None) -> DataFrame:
    """The k largest, overall or per group; ties by the given columns."""
    if not per:
        return series.orderBy(F.desc(value), *ties).limit(k)
    w = Window.partitionBy(*per).orderBy(F.desc(value), *ties)
    return series.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).drop("__r")


def label_values(samples: DataFrame, label: str) -> DataFrame:
    return samples.select(label).distinct()


def routed(alerts_: DataFrame, routes: dict[str, tuple[str, ...]], default: str) -> DataFrame:
    """One row per receiver of an alert: those of its severity, or the default."""
    table = F.create_map(*[x for k, v in routes.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return alerts_.withColumn("receiver", F.explode(F.coalesce(F.try_element_at(table, F.col("severity")), F.array(F.lit(default)))))


def sampled(traces: DataFrame, share: float, key: str = "trace_id") -> DataFrame:
    """A share of traces, the same ones wherever they appear."""
    low = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return traces.where(low < int(max(0.0, min(1.0, share)) * 2**32))


def bands(value: Column, warn: float, critical: float, high_is_bad: bool = True) -> Column:
    """ok, warn or critical."""
    worse = (lambda t: value > t) if high_is_bad else (lambda t: value < t)
    return F.when(worse(critical), "critical").when(worse(warn), "warn").otherwise("ok")


def exposition(samples: DataFrame, name: str, labels: list[str], value: str) -> DataFrame:
    """samples with the `line` that scrapers read: name{label="value",...} value. Labels that are null are left out, an endless bound is +Inf, a null value NaN."""

    def said(c: str) -> Column:
        number = dict(samples.dtypes)[c] in ("double", "float")
        whole = F.col(c) == F.floor(F.col(c).cast("double"))
        text = F.when(F.col(c) == float("inf"), "+Inf").when(whole, F.col(c).cast("long").cast("string")).otherwise(F.col(c).cast("string")) if number else F.col(c).cast("string")
        return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))

    pairs = F.array_join(F.array_compact(F.array(*[F.concat(F.lit(f'{c}="'), said(c), F.lit('"')) for c in labels]).cast("array<string>")), ",")
    held = F.when(pairs != "", F.concat(F.lit("{"), pairs, F.lit("}"))).otherwise("")
    return samples.withColumn("line", F.concat(F.lit(name), held, F.lit(" "), F.coalesce(said(value), F.lit("NaN"))))
