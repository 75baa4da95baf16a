"""Sinks of streams that write each batch once: a folder per batch, and a pointer that moves when a batch is whole.

A batch that fails or is run again replaces its own folder; one that the pointer has passed is not written again. Readers go by the pointer, so they never see half a batch. The pointer is one small file that is
renamed over the old one, which the file system does at once (HDFS, local disks); on an object store use one whose rename of one file is atomic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folio.operators import metrics

POINTER, BATCH = "_latest", "batch"


def latest(spark: SparkSession, root: str) -> int:
    """The last batch that is whole, or -1."""
    pointer = f"{root.rstrip('/')}/{POINTER}"
    p = spark._jvm.org.apache.hadoop.fs.Path(pointer)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return -1
    stream = fs.open(p)
    try:
        return int(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def point(spark: SparkSession, root: str, batch: int) -> None:
    """Moves the pointer to a batch; it never goes back."""
    if batch <= latest(spark, root):
        return
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    to, new = (jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}") for name in (POINTER, f"{POINTER}.{batch}"))
    fs = to.getFileSystem(conf)
    out = fs.create(new, True)
    try:
        out.write(bytearray(str(batch).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(new), fs.makeQualified(to), how)


def once(root: str, write: Callable[[DataFrame, str], None]) -> Callable[[DataFrame, int], None]:
    """What foreachBatch calls: write(batch, folder) for a batch that is not whole yet, then the pointer."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number > latest(spark, root):
            write(batch, f"{root.rstrip('/')}/{BATCH}={number}")
            point(spark, root, number)

    return run


def parquet_once(stream: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The rows of a stream as Parquet, each batch once. root belongs to this checkpoint: a new checkpoint counts its batches from 0 and needs a root of its own."""
    return stream.writeStream.foreachBatch(once(root, lambda b, to: b.write.mode("overwrite").parquet(to))).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def exposition_once(stream: DataFrame, root: str, checkpoint: str, name: str, labels: list[str], value: str, **trigger) -> StreamingQuery:
    """Samples of a stream as lines of the text format of metrics (operators/metrics.exposition), each batch once."""
    def write(batch: DataFrame, to: str) -> None:
        metrics.exposition(batch, name, labels, value).select("line").write.mode("overwrite").text(to)

    return stream.writeStream.outputMode("update").foreachBatch(once(root, write)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_batches(spark: SparkSession, root: str, schema) -> DataFrame:
    """The rows of all whole batches, with their `batch`; none yet give an empty table."""
    last = latest(spark, root)
    if last < 0:
        return spark.createDataFrame([], schema).withColumn(BATCH, F.lit(None).cast("long"))
    full = spark.createDataFrame([], schema).withColumn(BATCH, F.lit(0).cast("long")).schema
    return spark.read.schema(full).parquet(root).where(F.col(BATCH) <= last)
