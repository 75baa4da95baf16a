"""Batches that are written once, whatever is run again, and lines of metrics."""

import os

import pytest
from pyspark.sql import functions as F

from folio.operators import metrics
from folio.streaming import filters, sinks

SCHEMA = "id long, text string"


def numbers(df):
    return sorted(r.id for r in df.collect())


def test_a_restarted_query_writes_each_batch_once(spark, tmp_path):
    src, root, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    more = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "cast(id as string) as text").coalesce(1).write.mode("append").parquet(src)
    run = lambda: sinks.parquet_once(filters.parquet_stream(spark, src, SCHEMA, 1), root, check).awaitTermination()
    assert sinks.latest(spark, root) == -1 and sinks.read_batches(spark, root, SCHEMA).count() == 0
    more(0, 10)
    more(10, 20)
    run()
    assert sinks.latest(spark, root) == 1 and numbers(sinks.read_batches(spark, root, SCHEMA)) == list(range(20))
    # The driver is lost after the pointer moved but before the batch was committed: the batch runs again and must not come twice.
    for name in ("1", ".1.crc"):
        os.remove(f"{check}/commits/{name}")
    more(20, 30)
    run()
    got = sinks.read_batches(spark, root, SCHEMA)
    assert sinks.latest(spark, root) == 2 and numbers(got) == list(range(30)) and {r.batch for r in got.select("batch").distinct().collect()} == {0, 1, 2}


def test_half_a_batch_is_not_seen_and_is_replaced(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = lambda *ids: spark.createDataFrame([(i, str(i)) for i in ids], SCHEMA)
    tries = []

    def write(batch, to):
        tries.append(to)
        batch.write.mode("overwrite").parquet(to)
        if len(tries) == 2:
            raise OSError("lost")

    sink = sinks.once(root, write)
    sink(rows(1, 2), 0)
    with pytest.raises(OSError):
        sink(rows(3, 4), 1)
    assert numbers(sinks.read_batches(spark, root, SCHEMA)) == [1, 2]
    sink(rows(3, 4), 1)
    sink(rows(9), 0)
    sink(rows(9), 1)
    assert len(tries) == 3 and numbers(sinks.read_batches(spark, root, SCHEMA)) == [1, 2, 3, 4]
    sinks.point(spark, root, 0)
    assert sinks.latest(spark, root) == 1 and not [n for n in os.listdir(root) if n.startswith("_latest.")]


def test_lines_of_metrics(spark, tmp_path):
    rows = [('a"b\\c\nd', 0.5, 3.0), (None, float("inf"), None), ("x", 10.0, 1.25)]
    x = spark.createDataFrame(rows, "kind string, le double, n double")
    assert {r.line for r in metrics.exposition(x, "m", ["kind", "le"], "n").collect()} == {'m{kind="a\\"b\\\\c\\nd",le="0.5"} 3', 'm{le="+Inf"} NaN', 'm{kind="x",le="10"} 1.25'}
    assert metrics.exposition(x.limit(1), "m", [], "n").collect()[0].line == "m 3"
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(6).selectExpr("id", "if(id % 2 = 0, 'a', 'b') as text").coalesce(1).write.parquet(src)
    stream = filters.parquet_stream(spark, src, SCHEMA).groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    sinks.exposition_once(stream, root, str(tmp_path / "check"), "seen", ["text"], "n").awaitTermination()
    assert sorted(r.value for r in spark.read.text(f"{root}/batch=0").collect()) == ['seen{text="a"} 3', 'seen{text="b"} 3']
