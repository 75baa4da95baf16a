"""Queries of the alert expressions over raw samples of events, their holds and their groups, each with SQL of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio import constants as K
from folio.plans import rules
from folio.plans.registry import query
from folio.plans.views import table

#: Events are sparse, so minutes count as SCALE minutes; an evaluation every STEP seconds.
STEP, SCALE = 3600, 24


def _samples(spark, d):
    """Every event is a scrape of one of three instances. Counters grow through the day at a speed that depends on the day, and start anew each day."""
    e = table(spark, d, "events").select("ts", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("s"), F.concat(F.lit("i"), F.col("user_id") % 3).alias("instance"), (F.col("user_id") % 2).alias("u"))
    e = e.withColumn("day", F.floor(F.col("s") / 86400)).withColumn("c", F.col("s") - 86400 * F.col("day")).withColumn("phase", F.concat(F.lit("p"), "u"))
    day, c, i = F.col("day"), F.col("c"), F.col("event_id")
    one = lambda value, keep=None, **labels: (e.where(keep) if keep is not None else e).select("ts", "instance", *[x.alias(n) for n, x in labels.items()], value.cast("double").alias("value"))

    def buckets(bounds, middle, **labels):
        part = [F.struct(F.lit(float(b)).alias("le"), (c * (b / (b + middle))).alias("value")) for b in bounds] + [F.struct(F.lit(float("inf")).alias("le"), c.cast("double").alias("value"))]
        x = e.select("ts", "instance", *[v.alias(n) for n, v in labels.items()], F.explode(F.array(*part)).alias("z"))
        return x.select("ts", "instance", *labels, "z.*")

    kind, get = F.lit("input"), F.lit("GET")
    job, mount, fs = F.when(i % 4 == 0, "other").otherwise("svc"), F.when(i % 2 == 0, "/").otherwise("/data"), F.when(i % 3 == 0, "tmpfs").when(i % 3 == 1, "overlay").otherwise("ext4")
    statuses = e.select("ts", "instance", F.explode(F.array(F.struct(F.lit("500").alias("status"), (c * (day % 10) / 100).alias("value")), F.struct(F.lit("200").alias("status"), (c / 2).alias("value")))).alias("z"))
    return {
        "cpu_seconds": one(c * (1 + day % 10) / 50, mode=F.when(i % 5 == 0, "user").otherwise("idle")), "memory_available": one(day * 37 % 100 / 5), "memory_total": one(F.lit(100), keep=i % 2 == 0),
        "disk_available": one(day * 53 % 100 / 4, fstype=fs, mountpoint=mount), "disk_size": one(F.lit(100), keep=i % 4 != 1, fstype=fs, mountpoint=mount),
        "up": one(F.when((day % 5 == 2) & (F.col("u") == 1), 0).otherwise(1), job=job), "scrape_seconds": one(i % 5 + day % 2 - F.lit(0.4), job=job), "api_requests": statuses.select("ts", "instance", "z.*"),
        "api_bucket": buckets(K.BUCKETS["api_ms"], 5 * (1 + day % 10), route=F.concat(F.lit("r"), "u"), method=get), "ocr_bucket": buckets(K.BUCKETS["ocr_ms"], 25 * (1 + day % 10)),
        "ocr_confidence_sum": one((c + 1) * (50 + day % 20)), "ocr_confidence_count": one(c + 1), "validation_bucket": buckets(K.BUCKETS["validation_ms"], 15 * (1 + day % 12) * (1 + F.col("u")), phase=F.col("phase"), kind=kind),
        "validation_failed": one(c * (day % 10) / 100, phase=F.col("phase"), kind=kind), "validation_ok": one(c / 5, phase=F.col("phase"), kind=kind),
        "phase_runs": one(F.when(day % 3 == 0, c).otherwise(0), phase=F.col("phase"), status=F.when(i % 3 == 0, "ok").otherwise("error")),
    }


_E = """e AS MATERIALIZED (SELECT event_id AS i, epoch_us(ts) / 1e6 AS s, 'i' || (user_id % 3) AS instance, user_id % 2 AS u, 'p' || (user_id % 2) AS phase, floor(epoch_us(ts) / 1e6 / 86400)::BIGINT AS day,
  epoch_us(ts) / 1e6 - 86400 * floor(epoch_us(ts) / 1e6 / 86400)::BIGINT AS c FROM events)"""


def _sql_buckets(bounds: str, middle: str, labels: str = "") -> str:
    return f"SELECT instance, s{labels}, le, CASE WHEN isinf(le) THEN c ELSE c * (le / (le + {middle})) END::DOUBLE AS v FROM e, (SELECT unnest([{bounds}, 'inf'::DOUBLE]) AS le)"


def _sql_window(src: str, labels: str, w: int) -> str:
    """The samples of the w seconds up to each step, as long as any is in them."""
    on = "".join(f" AND k.{x} = g.{x}" for x in labels.split(", "))
    return f"""(SELECT {', '.join('g.' + x for x in labels.split(', '))}, g.t, k.s, k.v FROM (SELECT {labels}, unnest(range((ceil(min(s) / 3600) * 3600)::BIGINT, (ceil(max(s) / 3600) * 3600)::BIGINT + {w} - 3600 + 1, 3600)) AS t FROM {src} GROUP BY {labels}) g
      JOIN {src} k ON k.s > g.t - {w} AND k.s <= g.t{on})"""


def _sql_rate(src: str, labels: str, w: int) -> str:
    return f"""(SELECT {labels}, t, raw * (z - a + least(p2, CASE WHEN raw > 0 AND f >= 0 THEN (z - a) * f / raw ELSE p2 END) + q2) / (z - a) / {w} AS v FROM (
    SELECT *, CASE WHEN p >= gap * 1.1 THEN gap / 2 ELSE p END AS p2, CASE WHEN q >= gap * 1.1 THEN gap / 2 ELSE q END AS q2 FROM (SELECT *, (z - a) / (n - 1) AS gap, a - (t - {w}) AS p, t - z AS q FROM (
      SELECT {labels}, t, count(*) AS n, min(s) AS a, max(s) AS z, arg_min(v, s) AS f, sum(CASE WHEN b IS NULL THEN 0 WHEN v < b THEN v ELSE v - b END) AS raw
      FROM (SELECT *, lag(v) OVER (PARTITION BY {labels}, t ORDER BY s, v) AS b FROM {_sql_window(src, labels, w)}) GROUP BY {labels}, t HAVING count(*) >= 2 AND max(s) > min(s)))))"""


def _sql_instant(src: str, labels: str, w: int) -> str:
    return f"(SELECT {labels}, t, arg_max(v, s) AS v FROM {_sql_window(src, labels, w)} GROUP BY {labels}, t)"


def _sql_mean(src: str, labels: str, w: int) -> str:
    return f"(SELECT {labels}, t, avg(v) AS v FROM {_sql_window(src, labels, w)} GROUP BY {labels}, t)"


def _sql_slow(rule: str, src: str, by: str, w: int) -> str:
    key, own = (f"{by}, " if by else ""), ", ".join(dict.fromkeys(["instance", "le", *[x for x in by.split(", ") if x]]))
    said = f"concat_ws(',', {by})" if by else "''"
    return f"""SELECT '{rule}' AS rule, {said} AS labels, t, arg_min(CASE WHEN isinf(le) THEN lo ELSE lo + (le - lo) * (0.95 * total - below) / (v - below) END, le) AS value FROM (
      SELECT *, max(v) OVER (PARTITION BY {key}t) AS total, coalesce(lag(v) OVER (PARTITION BY {key}t ORDER BY le), 0) AS below, coalesce(lag(le) OVER (PARTITION BY {key}t ORDER BY le), 0) AS lo
      FROM (SELECT {key}le, t, sum(v) AS v FROM {_sql_rate(src, own, w)} GROUP BY ALL)) WHERE total > 0 AND v >= 0.95 * total GROUP BY {key}t"""


def _sql_failing(rule: str, by: str, w: int, budget: str = "") -> str:
    key, own = (f"{by}, " if by else ""), ("instance, " + by if by else "instance")
    said = f"concat_ws(',', {by})" if by else "''"
    side = lambda src: f"(SELECT {key}t, sum(v) AS v FROM {_sql_rate(src, own, w)} GROUP BY ALL)"
    return f"SELECT '{rule}' AS rule, {said} AS labels, t, a.v / (a.v + b.v){budget} AS value FROM {side('failed')} a JOIN {side('fine')} b USING ({key}t) WHERE a.v + b.v <> 0"


# The windows (5, 10 and 60 minutes, 24 times as long), bounds, thresholds and holds of the rules stand here once more, as numbers.
_VALUES = f"""{_E},
cpu AS MATERIALIZED (SELECT instance, s, CASE WHEN i % 5 = 0 THEN 'user' ELSE 'idle' END AS mode, c * (1 + day % 10) / 50 AS v FROM e),
idle AS MATERIALIZED (SELECT * FROM cpu WHERE mode = 'idle'),
mem_a AS MATERIALIZED (SELECT instance, s, (day * 37 % 100 / 5)::DOUBLE AS v FROM e), mem_t AS MATERIALIZED (SELECT instance, s, 100::DOUBLE AS v FROM e WHERE i % 2 = 0),
disk AS MATERIALIZED (SELECT instance, i, s, (day * 53 % 100 / 4)::DOUBLE AS v FROM e WHERE i % 3 = 2 AND i % 2 = 0), disk_t AS MATERIALIZED (SELECT instance, s, 100::DOUBLE AS v FROM disk WHERE i % 4 <> 1),
up AS MATERIALIZED (SELECT instance, s, CASE WHEN day % 5 = 2 AND u = 1 THEN 0 ELSE 1 END::DOUBLE AS v FROM e WHERE i % 4 <> 0), scrape AS MATERIALIZED (SELECT instance, s, (i % 5 + day % 2 - 0.4::DOUBLE) AS v FROM e WHERE i % 4 <> 0),
r500 AS MATERIALIZED (SELECT instance, s, c * (day % 10) / 100 AS v FROM e), r200 AS MATERIALIZED (SELECT instance, s, c / 2 AS v FROM e),
api AS MATERIALIZED ({_sql_buckets('5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000', '5 * (1 + day % 10)', ", 'r' || u AS route, 'GET' AS method")}),
ocr AS MATERIALIZED ({_sql_buckets('10, 20, 50, 100, 200, 500, 1000, 2000, 5000, 10000', '25 * (1 + day % 10)')}),
conf_s AS MATERIALIZED (SELECT instance, s, (c + 1) * (50 + day % 20) AS v FROM e), conf_c AS MATERIALIZED (SELECT instance, s, c + 1 AS v FROM e),
val AS MATERIALIZED ({_sql_buckets('1, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000', '15 * (1 + day % 12) * (1 + u)', ", phase, 'input' AS kind")}),
failed AS MATERIALIZED (SELECT instance, s, phase, 'input' AS kind, c * (day % 10) / 100 AS v FROM e), fine AS MATERIALIZED (SELECT instance, s, phase, 'input' AS kind, c / 5 AS v FROM e),
runs AS MATERIALIZED (SELECT instance, s, phase, CASE WHEN day % 3 = 0 THEN c ELSE 0 END::DOUBLE AS v FROM e WHERE i % 3 <> 0),
values_ AS MATERIALIZED (SELECT rule, labels, t, round(value, 6) AS value FROM (
SELECT 'node_cpu_high' AS rule, instance AS labels, t, 100 * (1 - avg(v)) AS value FROM {_sql_rate('idle', 'instance', 7200)} GROUP BY ALL
UNION ALL SELECT 'node_memory_high', instance, t, 100 * (1 - a.v / b.v) FROM {_sql_instant('mem_a', 'instance', 7200)} a JOIN {_sql_instant('mem_t', 'instance', 7200)} b USING (instance, t)
UNION ALL SELECT 'node_disk_high', instance, t, 100 * (1 - a.v / b.v) FROM {_sql_instant('disk', 'instance', 7200)} a JOIN {_sql_instant('disk_t', 'instance', 7200)} b USING (instance, t)
UNION ALL SELECT 'target_down', instance, t, v FROM {_sql_instant('up', 'instance', 7200)}
UNION ALL SELECT 'scrape_slow', instance, t, v FROM {_sql_mean('scrape', 'instance', 7200)}
UNION ALL SELECT 'api_error_rate_high', '', t, a.v / (a.v + b.v) FROM (SELECT t, sum(v) AS v FROM {_sql_rate('r500', 'instance', 7200)} GROUP BY t) a JOIN (SELECT t, sum(v) AS v FROM {_sql_rate('r200', 'instance', 7200)} GROUP BY t) b USING (t)
UNION ALL {_sql_slow('api_latency_high', 'api', 'route, method', 7200)}
UNION ALL {_sql_slow('ocr_latency_high', 'ocr', '', 7200)}
UNION ALL SELECT 'ocr_confidence_low', instance, t, a.v / b.v FROM {_sql_mean('conf_s', 'instance', 14400)} a JOIN {_sql_mean('conf_c', 'instance', 14400)} b USING (instance, t)
UNION ALL {_sql_slow('validation_latency_high', 'val', 'phase, kind', 14400)}
UNION ALL {_sql_failing('validation_fail_rate_high', 'phase, kind', 7200)}
UNION ALL SELECT 'phase_errors', phase, t, sum(v) FROM {_sql_rate('runs', 'instance, phase', 14400)} GROUP BY ALL
UNION ALL {_sql_failing('slo_burn_fast', '', 7200, ' / 0.02')}
UNION ALL {_sql_failing('slo_burn_slow', '', 86400, ' / 0.02')}
UNION ALL {_sql_slow('validation_latency_overall_high', 'val', '', 14400)}))"""

_HOLDS = """h(rule, op, threshold, hold, severity) AS (VALUES ('node_cpu_high', '>', 90, 600, 'warning'), ('node_memory_high', '>', 90, 600, 'warning'), ('node_disk_high', '>', 90, 900, 'warning'), ('target_down', '=', 0, 300, 'critical'),
  ('scrape_slow', '>', 2, 600, 'warning'), ('api_error_rate_high', '>', 0.05, 600, 'warning'), ('api_latency_high', '>', 500, 600, 'warning'), ('ocr_latency_high', '>', 2000, 600, 'warning'), ('ocr_confidence_low', '<', 60, 600, 'warning'),
  ('validation_latency_high', '>', 500, 600, 'warning'), ('validation_fail_rate_high', '>', 0.05, 600, 'warning'), ('phase_errors', '>', 0, 600, 'critical'), ('slo_burn_fast', '>', 5, 600, 'critical'), ('slo_burn_slow', '>', 1, 3600, 'warning'),
  ('validation_latency_overall_high', '>', 2000, 600, 'warning'))"""

_FIRING = f"""{_VALUES}, {_HOLDS}, y AS (SELECT v.*, hold * 24 AS hold, severity, t - 3600 * row_number() OVER (PARTITION BY rule, labels ORDER BY t) AS island FROM values_ v JOIN h USING (rule)
  WHERE CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold ELSE value = threshold END),
f AS (SELECT rule, severity, labels, min(t) + ((hold + 3599) // 3600) * 3600 AS begins, max(t) + 3600 AS ends FROM y GROUP BY rule, severity, labels, island, hold HAVING max(t) - min(t) >= hold)"""


def _values(spark, d):
    return rules.expressions(_samples(spark, d), STEP, SCALE).withColumn("value", F.round("value", 6))


@query(f"WITH {_VALUES} SELECT * FROM values_")
def alert_expressions(spark, d):
    return _values(spark, d)


@query(f"WITH {_FIRING} SELECT * FROM f WHERE begins < ends")
def alerts_firing(spark, d):
    return rules.firing(_values(spark, d), STEP, SCALE)


#: One group per severity; its clock waits an hour, ticks every two and repeats after twelve.
_CLOCK = (3600, 7200, 43200)


@query(f"""WITH RECURSIVE {_FIRING}, a AS MATERIALIZED (SELECT severity, begins, ends, row_number() OVER (PARTITION BY severity ORDER BY begins, ends) AS r FROM f WHERE begins < ends),
l AS (SELECT severity, r, begins, ends, begins AS opened, ends AS reach FROM a WHERE r = 1
  UNION ALL SELECT a.severity, a.r, a.begins, a.ends, CASE WHEN a.begins > l.opened + 3600 + 7200 * greatest(0, ceil((l.reach - l.opened - 3600) / 7200))::BIGINT THEN a.begins ELSE l.opened END,
    CASE WHEN a.begins > l.opened + 3600 + 7200 * greatest(0, ceil((l.reach - l.opened - 3600) / 7200))::BIGINT THEN a.ends ELSE greatest(l.reach, a.ends) END FROM l JOIN a ON a.severity = l.severity AND a.r = l.r + 1),
k AS (SELECT severity, opened, greatest(0, ceil((begins - opened - 3600) / 7200))::BIGINT AS b, greatest(0, ceil((ends - opened - 3600) / 7200))::BIGINT AS e FROM l),
ticks AS (SELECT severity, opened, max(e) AS last FROM k GROUP BY ALL), every AS (SELECT severity, opened, unnest(range(0, last + 1)) AS n FROM ticks),
c AS (SELECT x.severity, x.opened, x.n, count(*) FILTER (WHERE b <= x.n AND e > x.n) AS firing, count(*) FILTER (WHERE e = x.n) AS resolved, bool_or(b = x.n OR e = x.n) AS news FROM every x JOIN k ON k.severity = x.severity AND k.opened = x.opened GROUP BY ALL),
o AS (SELECT *, max(n) FILTER (WHERE news) OVER (PARTITION BY severity, opened ORDER BY n) AS since FROM c)
SELECT severity, opened, opened + 3600 + 7200 * n AS "at", firing, resolved FROM o WHERE news OR (firing > 0 AND (n - since) % 6 = 0)""")
def alert_groups(spark, d):
    return rules.grouped(rules.firing(_values(spark, d), STEP, SCALE), ["severity"], *_CLOCK)
