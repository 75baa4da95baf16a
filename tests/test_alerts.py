"""Instant vectors, matching and alert groups on small tables, against plain versions."""

import math
import random

from pyspark.sql import functions as F

from folio.operators import vectors
from folio.plans import rules


def test_instant_vectors_look_back_and_leave_gaps(spark):
    rows = [("a", 5, 1.0), ("a", 61, 2.0), ("a", 61, 3.0), ("a", 400, 4.0), ("b", 119, 5.0), ("b", 121, 6.0)]
    df = spark.createDataFrame(rows, "k string, s long, value double").withColumn("ts", F.timestamp_seconds("s"))
    got = {(r.k, r.t): r.value for r in vectors.instant(df, ["k"], 60, 180).collect()}
    want = {}
    for t in range(0, 1200, 60):
        for k in "ab":
            seen = [(s, v) for j, s, v in rows if j == k and t - 180 < s <= t]
            if seen:
                want[k, t] = max(seen)[1]
    assert got == want and ("a", 300) not in got


def test_division_by_zero(spark):
    left = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 0.0), ("c", 1, 6.0), ("d", 1, 1.0)], "k string, t long, value double")
    right = spark.createDataFrame([("a", 1, 0.0), ("b", 1, 0.0), ("c", 1, 2.0)], "k string, t long, value double")
    got = {r.k: r.value for r in vectors.matched(left, right, ["k"], "/").collect()}
    assert got["a"] == math.inf and math.isnan(got["b"]) and got["c"] == 3 and len(got) == 3


def plain(alerts, wait, interval, repeat):
    """Every group's clock, tick by tick."""
    out = []
    for k in {a[0] for a in alerts}:
        left = sorted(a[1:] for a in alerts if a[0] == k)
        while left:
            opened, at, said, told = left[0][0], left[0][0] + wait, None, -math.inf
            while True:
                before = at - interval if said is not None else -math.inf
                here = [a for a in left if a[0] <= at]
                firing, ended = sum(e > at for _, e in here), sum(before < e <= at for _, e in here)
                begun = any(before < b for b, _ in here)
                if begun or ended or (firing and at - told >= repeat):
                    out.append((k, opened, at, firing, ended))
                    told = at
                said = at
                if not firing:
                    left = [a for a in left if a[0] > at]
                    break
                at += interval
    return sorted(out)


def test_groups_share_one_clock(spark):
    r = random.Random(4)
    alerts = [(k, b, b + r.choice((10, 100, 500, 5000))) for k in "xyz" for b in sorted(r.sample(range(0, 40_000), 40))]
    df = spark.createDataFrame(alerts, "k string, begins long, ends long").repartition(3)
    for clock in ((30, 300, 3600), (0, 60, 60), (500, 100, 250)):
        got = rules.grouped(df, ["k"], *clock).collect()
        assert sorted(tuple(g) for g in got) == plain(alerts, *clock)
