"""Recorded series and burn rates over tables of measurements: validations (ts, phase, kind, ms, failed) and API calls (ts, route, method, ms).

Every function gives the value for the `seconds` up to each step; RECORDED holds what is kept under a name."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio import constants as K
from folio.operators import logs, metrics, vectors

SECONDS, STEP = 300, 30
#: Name -> (table, labels, quantile, or None for the share of failures).
RECORDED = {
    "validation_p95_ms_overall": ("validations", (), 0.95), "validation_p95_ms": ("validations", ("phase", "kind"), 0.95), "validation_p99_ms": ("validations", ("phase", "kind"), 0.99),
    "validation_fail_rate": ("validations", ("phase", "kind"), None), "api_p95_ms": ("calls", ("route", "method"), 0.95),
}
#: The bounds of each table's histogram.
BOUNDS = {"validations": "validation_ms", "calls": "api_ms"}
#: The share of failures that is allowed; how fast it may be used: name -> (seconds, times).
BUDGET, BURNS = 0.02, {"fast": (300, 5.0), "slow": (3600, 1.0)}


def fail_share(samples: DataFrame, labels: list[str], seconds: int, step: int) -> DataFrame:
    """(labels, t, value): failed samples to all."""
    s = samples.withColumn("failed", F.col("failed").cast("double"))
    return metrics.sliding_average(s, labels, seconds, step, value="failed").withColumnRenamed("average", "value")


def recorded(name: str, tables: dict[str, DataFrame], seconds: int = SECONDS, step: int = STEP) -> DataFrame:
    """(rule, labels, t, value) of a recorded series; labels as one string."""
    table, labels, q = RECORDED[name]
    if q is None:
        x = fail_share(tables[table], list(labels), seconds, step)
    else:
        x = metrics.sliding_quantile(tables[table], K.BUCKETS[BOUNDS[table]], list(labels), q, seconds, step, value="ms").withColumnRenamed("quantile", "value")
    return x.select(F.lit(name).alias("rule"), F.concat_ws(",", *labels).alias("labels"), "t", "value")


def burns(validations: DataFrame, step: int = STEP, scale: int = 1) -> DataFrame:
    """(speed, t, burn, firing): how many times faster than allowed failures come, over each of BURNS' times (lengthened by `scale`), and whether that is too fast."""
    out = None
    for speed, (seconds, most) in BURNS.items():
        # Steps are few; one label that all rows share keeps them together.
        x = fail_share(validations.withColumn("all", F.lit("")), ["all"], seconds * scale, step)
        x = x.select(F.lit(speed).alias("speed"), "t", (F.col("value") / BUDGET).alias("burn")).withColumn("firing", F.col("burn") > most)
        out = x if out is None else out.unionByName(x)
    return out


# Rule -> (series, comparison, threshold, seconds for which it must hold, severity).
ALERTS = {
    "node_cpu_high": ("node_cpu_percent", ">", 90.0, 600, "warning"), "node_memory_high": ("node_memory_percent", ">", 90.0, 600, "warning"), "node_disk_high": ("node_disk_percent", ">", 90.0, 900, "warning"),
    "target_down": ("up", "==", 0.0, 300, "critical"), "scrape_slow": ("scrape_seconds_average", ">", 2.0, 600, "warning"), "api_error_rate_high": ("api_error_share", ">", 0.05, 600, "warning"),
    "api_latency_high": ("api_p95_ms", ">", 500.0, 600, "warning"), "ocr_latency_high": ("ocr_p95_ms", ">", 2000.0, 600, "warning"), "ocr_confidence_low": ("ocr_confidence_average", "<", 60.0, 600, "warning"),
    "validation_latency_high": ("validation_p95_ms", ">", 500.0, 600, "warning"), "validation_fail_rate_high": ("validation_fail_rate", ">", 0.05, 600, "warning"), "phase_errors": ("phase_error_rate", ">", 0.0, 600, "critical"),
    "slo_burn_fast": ("burn_fast", ">", 5.0, 600, "critical"), "slo_burn_slow": ("burn_slow", ">", 1.0, 3600, "warning"), "validation_latency_overall_high": ("validation_p95_ms_overall", ">", 2000.0, 600, "warning"),
}


def fired(series: DataFrame, step: int, scale: int = 1) -> DataFrame:
    """(rule, severity, labels, begins, ends) of the stretches of evaluations, `step` seconds apart, at which a rule's condition held on series (series, labels, t, value) for
    its time (lengthened by `scale`) at least. An absent evaluation ends a stretch. All rules go through one plan."""
    spark = series.sparkSession
    rules = spark.createDataFrame([(n, *r) for n, r in ALERTS.items()], "rule string, series string, op string, threshold double, hold long, severity string")
    v, t = F.col("value"), F.col("threshold")
    holds = F.when(F.col("op") == ">", v > t).when(F.col("op") == "<", v < t).otherwise(v == t)
    w = Window.partitionBy("rule", "labels").orderBy("t")
    x = series.join(F.broadcast(rules), "series").where(holds)  # as many rows as there are rules
    x = x.withColumn("new", (F.coalesce(F.col("t") - F.lag("t").over(w), F.lit(step + 1)) > step).cast("int")).withColumn("island", F.sum("new").over(w))
    g = x.groupBy("rule", "severity", "labels", "island").agg(F.min("t").alias("begins"), F.max("t").alias("ends"), F.first("hold").alias("hold"))
    return g.where(F.col("ends") - F.col("begins") >= F.col("hold") * scale).select("rule", "severity", "labels", "begins", "ends")


# ---- the alert expressions over raw samples

MINUTE = 60


def expressions(samples: dict[str, DataFrame], step: int, scale: int = 1) -> DataFrame:
    """(rule, labels, t, value): what each rule of ALERTS compares, from raw samples (ts, label columns, value) by name of the metric, at every step. Windows are
    lengthened by `scale`; labels are one string."""
    m = MINUTE * scale

    def rate(name: str, labels: list[str], minutes: int, *where: Column) -> DataFrame:
        return vectors.rate(vectors.selected(samples[name], *where), labels, minutes * m, step)

    def now(name: str, labels: list[str], *where: Column) -> DataFrame:
        return vectors.instant(vectors.selected(samples[name], *where), labels, step, 5 * m)

    def slow(name: str, minutes: int, by: list[str]) -> DataFrame:
        by_instance = list(dict.fromkeys(["instance", "le", *by]))
        return vectors.bucket_quantile(vectors.total(rate(name, by_instance, minutes), ["le", *by]), 0.95, by)

    def failing(minutes: int, by: list[str]) -> DataFrame:
        own = ["instance", *by]
        failed, fine = (vectors.total(rate(n, own, minutes), by) for n in ("validation_failed", "validation_ok"))
        return vectors.matched(failed, vectors.matched(failed, fine, by, "+"), by, "/")

    kind, route = ["phase", "kind"], ["route", "method"]
    disk = [~logs.matches(F.col("fstype"), "tmpfs|overlay"), F.col("mountpoint") == "/"]
    free = lambda v: vectors.changed(v, lambda x: 100 * (1 - x))
    part = lambda a, b, *where: free(vectors.matched(now(a, ["instance"], *where), now(b, ["instance"], *where), ["instance"], "/"))
    own = F.col("job") == "svc"
    mean = lambda name, minutes, *where: vectors.average(vectors.selected(samples[name], *where), ["instance"], minutes * m, step)
    requests = ["instance", "status"]
    burn = lambda minutes: vectors.changed(failing(minutes, []), lambda x: x / BUDGET)
    every = {
        "node_cpu_high": (free(vectors.mean(rate("cpu_seconds", ["instance", "mode"], 5, F.col("mode") == "idle"), ["instance"])), ["instance"]),
        "node_memory_high": (part("memory_available", "memory_total"), ["instance"]), "node_disk_high": (part("disk_available", "disk_size", *disk), ["instance"]),
        "target_down": (now("up", ["instance"], own), ["instance"]), "scrape_slow": (mean("scrape_seconds", 5, own), ["instance"]),
        "api_error_rate_high": (vectors.matched(vectors.total(rate("api_requests", requests, 5, logs.matches(F.col("status"), "5..")), []), vectors.total(rate("api_requests", requests, 5), []), [], "/"), []),
        "api_latency_high": (slow("api_bucket", 5, route), route), "ocr_latency_high": (slow("ocr_bucket", 5, []), []),
        "ocr_confidence_low": (vectors.matched(mean("ocr_confidence_sum", 10), mean("ocr_confidence_count", 10), ["instance"], "/"), ["instance"]),
        "validation_latency_high": (slow("validation_bucket", 10, kind), kind), "validation_fail_rate_high": (failing(5, kind), kind),
        "phase_errors": (vectors.total(rate("phase_runs", ["instance", "phase", "status"], 10, F.col("status") == "error"), ["phase"]), ["phase"]),
        "slo_burn_fast": (burn(5), []), "slo_burn_slow": (burn(60), []), "validation_latency_overall_high": (slow("validation_bucket", 10, []), []),
    }
    rows = [v.select(F.lit(rule).alias("rule"), F.concat_ws(",", *labels).alias("labels"), "t", "value") for rule, (v, labels) in every.items()]
    return functools.reduce(DataFrame.unionByName, rows)


def firing(values: DataFrame, step: int, scale: int = 1) -> DataFrame:
    """(rule, severity, labels, begins, ends) of alerts: from the evaluation at which a rule's condition (ALERTS) has held for its time to the first at which it does not hold or is absent."""
    series = values.select(F.col("rule").alias("name"), "labels", "t", "value")
    table = values.sparkSession.createDataFrame([(n, r[0]) for n, r in ALERTS.items()], "name string, series string")
    got = fired(series.join(F.broadcast(table), "name").drop("name"), step, scale)
    holds = F.create_map(*[F.lit(x) for n, r in ALERTS.items() for x in (n, r[3] * scale)])
    first = F.ceil((F.col("begins") + F.element_at(holds, F.col("rule"))) / step) * step
    return got.select("rule", "severity", "labels", first.cast("long").alias("begins"), (F.col("ends") + step).alias("ends")).where("begins < ends")


def notified(alerts: DataFrame, wait: int = 30, repeat: int = 3600) -> DataFrame:
    """(rule, severity, labels, at): when word goes out on fired alerts, one group per rule and labels: `wait` seconds after a stretch begins, and again every `repeat` seconds while it lasts."""
    first = F.col("begins") + wait
    return alerts.select("rule", "severity", "labels", F.explode(F.when(F.col("ends") >= first, F.sequence(first, F.col("ends"), F.lit(repeat).cast("long"))).otherwise(F.array(first))).alias("at"))


# What is told apart when alerts are grouped, and the seconds of a group's clock.
WAIT, INTERVAL, REPEAT = 30, 300, 3600


def grouped(alerts: DataFrame, by: list[str], wait: int = WAIT, interval: int = INTERVAL, repeat: int = REPEAT) -> DataFrame:
    """(by, opened, at, firing, resolved): the notifications of alert groups.

    Alerts (by, begins, ends) of one group share a clock, which starts with the first of them and ticks `wait` seconds later and then every `interval`. A tick tells of
    the group if an alert has begun or ended since the last tick, or if `repeat` seconds have gone by since word went out and any fires. `firing` counts those that fire at the tick, `resolved` those that ended
    since the one before. After a tick at which none fires, the group is closed; the next alert opens it anew.

    Only alerts of a stretch without a pause of wait + interval, which closes any group, are brought together."""
    key = Window.partitionBy(*by).orderBy("begins", "ends")
    reach = F.max("ends").over(key.rowsBetween(Window.unboundedPreceding, -1))
    x = alerts.select(*by, "begins", "ends").withColumn("__new", F.coalesce(F.col("begins") - reach > wait + interval, F.lit(True)).cast("int"))
    x = x.withColumn("__part", F.sum("__new").over(key)).groupBy(*by, "__part").agg(F.array_sort(F.collect_list(F.struct("begins", "ends"))).alias("__run"))
    # The tick (number from 0) at which something at time s is told, on the clock of a group opened at o.
    tick = lambda s, o: f"greatest(0L, cast(ceil(({s} - {o} - {wait}) / {interval}) as bigint))"
    closes = f"st.opened + {wait} + {interval} * {tick('st.reach', 'st.opened')}"
    first = "named_struct('opened', __run[0].begins, 'reach', __run[0].ends, 'of', array(__run[0].begins))"
    step = f"""(st, a) -> if(a.begins > {closes}, named_struct('opened', a.begins, 'reach', a.ends, 'of', concat(st.of, array(a.begins))),
      named_struct('opened', st.opened, 'reach', greatest(st.reach, a.ends), 'of', concat(st.of, array(st.opened))))"""
    x = x.withColumn("__of", F.expr(f"aggregate(slice(__run, 2, size(__run)), {first}, {step}).of"))
    each = x.select(*by, F.explode(F.arrays_zip(F.col("__run").alias("run"), F.col("__of").alias("of"))).alias("__z"))
    each = each.select(*by, F.col("__z.of").alias("opened"), F.col("__z.run.begins").alias("__begins"), F.col("__z.run.ends").alias("__ends"))
    mark = lambda at, up, down: F.struct(F.expr(tick(at, "opened")).alias("k"), F.lit(up).alias("up"), F.lit(down).alias("down"))
    marks = each.select(*by, "opened", F.explode(F.array(mark("__begins", 1, 0), mark("__ends", 0, 1))).alias("__m"))
    g = marks.groupBy(*by, "opened", F.col("__m.k").alias("__k")).agg(F.sum("__m.up").alias("__up"), F.sum("__m.down").alias("__down"))
    life = Window.partitionBy(*by, "opened").orderBy("__k")
    g = g.withColumns({"firing": F.sum(F.col("__up") - F.col("__down")).over(life), "__next": F.lead("__k").over(life)})
    every = max(1, -(-repeat // interval))
    again = F.sequence(F.col("__k"), F.col("__next") - 1, F.lit(every).cast("long"))
    told = g.withColumn("__at", F.explode(F.when((F.col("firing") > 0) & F.col("__next").isNotNull(), again).otherwise(F.array("__k"))))
    resolved = F.when(F.col("__at") == F.col("__k"), F.col("__down")).otherwise(0).cast("long")
    return told.select(*by, "opened", (F.col("opened") + wait + F.col("__at") * interval).alias("at"), "firing", resolved.alias("resolved"))
