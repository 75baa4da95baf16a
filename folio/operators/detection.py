"""PDF types from page metrics: which pages are looked at, how a document's pages vote, and what it is read as.

Metrics are a table (doc_id, page from 0, text_len, words, blocks, images, image_area), whatever reader made them; a window or
group holds the pages of one document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import detect


def voted(metrics: DataFrame) -> DataFrame:
    """The metrics with the page's vote v (native_score, ocr_score, mode), its rank by image share, and the document's pages and largest share."""
    w = Window.partitionBy("doc_id")
    vote = detect.page_vote(F.col("text_len"), F.col("words"), F.col("blocks"), F.col("images"), F.col("image_area"))
    rank = F.row_number().over(w.orderBy(F.desc("image_area"), "page"))
    return metrics.withColumns({"v": vote, "pages": F.max("page").over(w) + 1, "rank": rank, "largest": F.max("image_area").over(w)})


def sampled(metrics: DataFrame) -> DataFrame:
    """The pages that are looked at: the first, middle and last, and the TOP_PAGES of largest image share."""
    x = voted(metrics)
    ends = (F.col("page") == 0) | (F.col("page") == F.expr("pages div 2")) | (F.col("page") == F.col("pages") - 1)
    return x.where(ends | (F.col("rank") <= detect.TOP_PAGES))


def document_votes(metrics: DataFrame) -> DataFrame:
    """(doc_id, pages, sampled, mixed, scanned, confidence)"""
    g = sampled(metrics).groupBy("doc_id").agg(
        F.max("pages").alias("pages"), F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("v.mode") == "native").alias("n"), F.count_if(F.col("v.mode") == "ocr").alias("o"), F.max("largest").alias("largest")
    )
    vote = detect.document_vote(F.col("n"), F.col("o"), F.col("sampled"), F.col("largest"))
    return g.withColumn("v", vote).select("doc_id", "pages", "sampled", "v.*")


def pdf_types(metrics: DataFrame) -> DataFrame:
    """(doc_id, file_type, ocr_recommended, mode, dpi, confidence) of PDFs."""
    t = document_votes(metrics).withColumn("t", detect.pdf_type(F.col("mixed"), F.col("scanned")))
    return t.select("doc_id", "t.*", "confidence")
