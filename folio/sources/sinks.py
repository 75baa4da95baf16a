"""Sinks: page and child tables as JSON lines, CSV, text and Parquet, laid out by run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGES = ("detect", "encoding", "readers")


def stage_dir(root: str, stage: str, session: str | None = None) -> str:
    """The folder of a stage's output, in a session's folder if one is given."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage: {stage}")
    return "/".join(x.strip("/") if i else x.rstrip("/") for i, x in enumerate((root, session, stage)) if x)


def json_lines(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Nulls are not written, so an absent confidence has no key."""
    w = df.write.mode(mode)
    (w.partitionBy(*by) if by else w).json(path)


def parquet(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "errorifexists") -> None:
    w = df.write.mode(mode)
    (w.partitionBy(*by) if by else w).parquet(path)


def page_text(pages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Each page as a header line and its text."""
    head = F.format_string("# file=%s page=%d source=%s conf=%.2f", F.col("doc_id").cast("string"), F.col("page"), F.col("source"), F.col("conf"))
    pages.select(F.concat_ws("\n", head, F.col("text")).alias("value")).write.mode(mode).text(path)


def page_csv(stats: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Page statistics with a header; lists are joined by commas."""
    lists = [f.name for f in stats.schema if f.dataType.typeName() == "array"]
    stats.withColumns({c: F.array_join(c, ",") for c in lists}).write.mode(mode).option("header", "true").csv(path)


def document_json(meta: DataFrame, path: str, mode: str = "errorifexists") -> None:
    meta.write.mode(mode).json(path)


def log_files(records: DataFrame, root: str, mode: str = "append") -> None:
    """Records under flow, UTC day, run and phase, so that readers of one day or run skip the rest."""
    json_lines(records.withColumn("day", F.to_date("ts")), root, ["flow", "day", "run_id", "phase"], mode)
