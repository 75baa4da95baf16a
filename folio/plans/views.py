"""The provided tables as this engine's inputs: events as log records and metric samples, conversations as paged documents with boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_records(events: DataFrame) -> DataFrame:
    """Errors and purchases are errors and warnings; a third of the errors carries a code; every fifth user has no phase."""
    e = F.col("event_type")
    return events.select(
        "event_id", "ts", F.when(e == "error", "ERROR").when(e == "purchase", "WARNING").otherwise("INFO").alias("level"), F.concat(F.lit("user"), (F.col("user_id") % 7).cast("string")).alias("logger"),
        e.alias("message"), F.when((e == "error") & (F.col("user_id") % 3 == 0), F.concat(F.lit("VL-E00"), (F.col("user_id") % 5).cast("string"))).alias("code"), F.date_format("ts", "yyyyMMdd").alias("run_id"),
        F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("phase_0"), (F.col("user_id") % 4).cast("string"))).alias("phase"), "user_id", "value", "props",
    )


LOGS = """logs AS (SELECT event_id, ts, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' ELSE 'INFO' END AS level, 'user' || (user_id % 7) AS logger, event_type AS message,
  CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN 'VL-E00' || (user_id % 5) END AS code, strftime(ts, '%Y%m%d') AS run_id, CASE WHEN user_id % 5 <> 0 THEN 'phase_0' || (user_id % 4) END AS phase, user_id, value, props FROM events)"""


def boxes(turns: DataFrame) -> DataFrame:
    """A block per turn, four to a page of 600 by 850, placed by whole-number rules."""
    return turns.selectExpr(
        "conv_id as doc_id", "cast(floor(turn / 4) as int) + 1 as page", "cast(turn % 4 as int) as block", "text", "600D as width", "850D as height",
        "array(cast(50 + conv_id * 13 % 80 as double), cast(10 + turn % 4 * 220 + conv_id * 7 % 60 as double), cast(250 + conv_id * 13 % 80 + conv_id * turn % 250 as double), cast(30 + turn % 4 * 220 + conv_id * 7 % 60 + turn * 37 % 150 as double)) as bbox",
    )


BOXES = """boxes AS (SELECT conv_id AS doc_id, floor(turn / 4)::INT + 1 AS page, (turn % 4)::INT AS block, text, 600::DOUBLE AS width, 850::DOUBLE AS height,
  [(50 + conv_id * 13 % 80)::DOUBLE, (10 + turn % 4 * 220 + conv_id * 7 % 60)::DOUBLE, (250 + conv_id * 13 % 80 + conv_id * turn % 250)::DOUBLE, (30 + turn % 4 * 220 + conv_id * 7 % 60 + turn * 37 % 150)::DOUBLE] AS bbox FROM conversations)"""


def numbers(spark: SparkSession, rows: str, names: str) -> DataFrame:
    """A small table of VALUES that both engines read alike."""
    return spark.sql(f"SELECT * FROM (VALUES {rows}) AS t({names})")
