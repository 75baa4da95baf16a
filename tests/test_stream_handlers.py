"""Handlers over streams equal those over tables; late records, and state that shrinks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from folio.operators import logs
from folio.streaming import filters, handlers

SCHEMA = "id long, ts timestamp, level string, logger string, message string, code string"
START = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(key, None)
    spark.conf.set(key, handlers.STORE)
    yield spark
    spark.conf.set(key, was) if was else spark.conf.unset(key)


def at(seconds):
    return START + dt.timedelta(microseconds=round(seconds * 1e6))


def run(spark, tmp_path, batches, handler, late, **given):
    """(ids that the handler writes, rows of state after each batch) of batches that come one after the other."""
    src, check, name = str(tmp_path / "in"), str(tmp_path / "check"), f"seen_{random.randrange(10**9)}"
    got, state = [], []

    def keep(batch, number):
        got.extend(r.id for r in batch.collect())

    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = handlers.handled(filters.parquet_stream(spark, src, SCHEMA, 1), handler, "ts", "id", late, **given)
        q = stream.writeStream.queryName(name).foreachBatch(keep).option("checkpointLocation", check).trigger(availableNow=True).start()
        q.awaitTermination()
        state.append(sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"]))
    return got, state


@pytest.mark.parametrize("handler", ["json_file", "console"])
def test_a_stream_equals_its_table(rocks, tmp_path, handler):
    r = random.Random(7)
    times = sorted(r.choice([i * 0.5, r.random() * 60]) for i in range(160))
    rows = [(i, at(t), r.choice(["INFO", "ERROR", "DEBUG"]), r.choice(["a", "PIL"]), r.choice(["x", "y", None]), "c") for i, t in enumerate(times)]
    given = {"ttl": 2.0, "every": 2, "window": 5.0, "most": 2}
    batch = logs.handled(rocks.createDataFrame(rows, SCHEMA), handler, F.unix_micros("ts") / 1e6, ["ts", "id"], **given)
    wanted = sorted(x.id for x in batch.collect())
    mixed = [(i // 60, r.random(), x) for i, x in enumerate(rows)]
    groups = [[x for b, _, x in sorted(mixed, key=lambda m: m[:2]) if b == n] for n in range(3)]
    end = [[(1000, at(500), "INFO", "z", "end", "c")], [(1001, at(1500), "INFO", "z", "end", "c")], [(1002, at(2500), "INFO", "z", "end", "c")]]
    got, state = run(rocks, tmp_path, [*groups, *end], handler, "1 minute", **given)
    assert sorted(i for i in got if i < 1000) == wanted and len(wanted) > 5 and len(got) == len(set(got))
    assert state[-1] < max(state) / 2


def test_late_records_are_lost_and_no_others(rocks, tmp_path):
    line = lambda i, t, m="m": (i, at(t), "INFO", "a", m, "c")
    batches = [[line(1, 100), line(2, 101.999999), line(3, 102)], [line(4, 95, "n"), line(5, 300)], [line(6, 50, "o"), line(7, 295, "p")], [line(8, 900)], [line(9, 1900)]]
    got, state = run(rocks, tmp_path, batches, "json_file", "10 seconds", ttl=2.0)
    assert sorted(i for i in got if i < 8) == [1, 3, 4, 5, 7]  # 6 is late; 2 comes less than two seconds after 1
    assert max(state) <= 9 and state[-1] <= 3
