"""The document chain as one lazy plan: files -> type -> encoding -> pages -> statistics -> summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.constants import PROFILES, Profile
from folio.functions import detect, encoding
from folio.operators import charset, detection, readers
from folio.sources import files as S
from folio.sources import pdf


@dataclass(frozen=True)
class Stages:
    """The tables of a run; each is computed only when it is used."""

    detected: DataFrame
    encoded: DataFrame
    pages: DataFrame
    page_stats: DataFrame
    summaries: DataFrame
    unread: DataFrame
    items: DataFrame
    summary: DataFrame
    failed: DataFrame


def detected(files: DataFrame) -> DataFrame:
    """Every item once. One without a path or that could not be opened (length null) stays, as unknown with confidence 0 and its error."""
    fault = F.when(F.coalesce("path", F.lit("")) == "", "no path").when(F.col("length").isNull(), "cannot be opened")
    kind = detect.guarded_type(F.col("path"), fault)
    return files.select("path", "length", detect.extension(F.col("path")).alias("ext"), detect.media_type(F.col("path")).alias("mime"), kind.alias("k")).select("path", "length", "ext", "mime", "k.*")


def typed_pdfs(found: DataFrame, metrics: DataFrame) -> DataFrame:
    """detected() items whose PDFs have the type, mode, resolution and confidence that their pages (operators/detection.py, doc_id is the path) vote for; a PDF without pages stays text, with confidence 0."""
    t = detection.pdf_types(metrics).select(F.col("doc_id").alias("path"), F.struct("file_type", "ocr_recommended", "confidence", "mode", "dpi").alias("__t"))
    is_pdf = F.col("file_type") == "pdf_text"
    of = lambda c: F.when(is_pdf & F.col("__t").isNotNull(), F.col("__t")[c]).otherwise(F.col(c))
    x = found.join(t, "path", "left")
    said = {c: of(c) for c in ("file_type", "ocr_recommended", "mode")} | {"confidence": F.when(is_pdf, F.coalesce(F.col("__t.confidence"), F.lit(0.0))).otherwise(F.col("confidence"))}
    said |= {"dpi": F.when(is_pdf, F.coalesce(F.col("__t.dpi"), F.lit(detect.PDF_DPI))).otherwise(F.col("dpi")), "psm": F.when(is_pdf, F.lit(detect.IMAGE_PSM)).otherwise(F.col("psm"))}
    return x.withColumns(said).select(*found.columns)


def failed(found: DataFrame, read_faults: DataFrame) -> DataFrame:
    """(path, stage, error): the items of a run that a stage could not handle, beside its results."""
    a = found.where("error is not null").select("path", F.lit("detect").alias("stage"), "error")
    return a.unionByName(read_faults.select("path", F.lit("read").alias("stage"), "error"))


def encoded(files: DataFrame, policy: str = "lf") -> DataFrame:
    """Encoding of the text-like files, and where their normalised form belongs."""
    e = encoding.detect(F.col("content"))
    text_like = files.where(detect.route(detect.file_type(F.col("path"))["file_type"]) == "encoding")
    return text_like.select("path", e.alias("e"), encoding.normalized_path(F.col("path")).alias("normalized_path")).select("path", "e.*", "normalized_path")


def normalised(files: DataFrame, policy: str = "lf", model: dict | None = None) -> DataFrame:
    """files whose text files hold their normalised form: UTF-8 without a mark, newlines by the policy. With a `model` (charset.fit) their encodings are told by it, else by encoding.detect()."""
    kind = detect.file_type(F.col("path"))["file_type"]
    if model is None:
        text = encoding.decode(F.col("content"), encoding.detect(F.col("content"))["encoding"], policy)
        return files.withColumn("content", F.when(kind == "txt", text.cast("binary")).otherwise(F.col("content")))
    told = charset.detect(F.when(kind == "txt", F.col("content")), model, files.sparkSession)
    x = charset.decoded(files.withColumn("__e", told["encoding"]), "content", "__e")
    return x.withColumn("content", F.when(F.col("text").isNotNull(), encoding.newlines(F.col("text"), policy).cast("binary")).otherwise(F.col("content"))).select(*files.columns)


def readers_items(found: DataFrame, normalized: DataFrame) -> DataFrame:
    """What the readers get: each detected file once, under its normalised path if it has one, with the options that detection recommends."""
    n = normalized.select("path", "normalized_path")
    joined = found.join(n, "path", "left")
    return joined.select(
        "path", F.coalesce("normalized_path", "path").alias("effective_path"), "file_type", detect.option(F.col("mode"), "off").alias("mode"), detect.option(F.col("tables_mode"), "off", "none").alias("tables_mode"),
        "dpi", "psm", F.col("ocr_lang").alias("lang"), "confidence", "error",
    )


def chain_summary(items: DataFrame, normalized: DataFrame, documents: DataFrame) -> DataFrame:
    """One row: what came in, was routed to encoding, was normalised, and was read, with the mean confidences."""
    a = items.agg(F.count(F.lit(1)).alias("items"), F.count_if(detect.route(F.col("file_type")) == "encoding").alias("to_encoding"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("detect_confidence"))
    b = normalized.agg(F.count_if(F.col("normalized_path").isNotNull()).alias("normalized"))
    c = readers.stage_stats(documents).withColumnsRenamed({"documents": "read", "avg_conf": "read_confidence"})
    one = lambda df: df.withColumn("one", F.lit(1))
    return one(a).join(one(b), "one").join(one(c), "one").drop("one")


def detect_stats(items: DataFrame) -> DataFrame:
    return items.groupBy("file_type").agg(F.count(F.lit(1)).alias("n"))


def encoding_stats(items: DataFrame) -> DataFrame:
    return items.agg(F.count(F.lit(1)).alias("total_items"), F.count_if(F.col("encoding").isNotNull()).alias("normalized"), F.count_if("bom").alias("with_bom"), F.count_if("is_utf8").alias("utf8_native"))


def run(spark: SparkSession, inputs: list[str], run_id: str, profile: str = "prod", model: dict | None = None) -> Stages:
    """All stages over files, folders or globs; every table carries the run's id. The pages of PDFs say what type they are; scanned ones are also in `unread`, as their images need OCR. Readers get the normalised text; `model` tells encodings other than UTF-8 (else Latin-1 is taken)."""
    p: Profile = PROFILES[profile]
    files = S.binary(spark, inputs)
    stamp = lambda df: df.withColumn("run_id", F.lit(run_id))
    pages = S.read_pages(normalised(files, model=model)).withColumnRenamed("path", "doc_id")
    pdfs = files.where(detect.file_type(F.col("path"))["file_type"] == "pdf_text")
    found, normalized, summaries = typed_pdfs(detected(files), pdf.metrics(pdfs)), encoded(files), readers.document_summary(pages, p)
    scanned = found.where("file_type = 'pdf_scanned'").select("path", F.col("file_type").alias("kind"), F.lit("no_reader:ocr").alias("reason"))
    items = readers_items(found, normalized)
    made = (found, normalized, pages, readers.page_stats(pages, p), summaries, S.unread(files).unionByName(scanned), items, chain_summary(items, normalized, summaries), failed(found, S.read_faults(files)))
    return Stages(*map(stamp, made))
