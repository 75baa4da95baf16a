"""Records that a reading run leaves behind: blocks with a fallback, table states, warnings, tool events, flagged pages, fallback statistics, geometry.

All work on tables keyed by document and page; a group holds what belongs to one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.functions.text import case
from folio.operators.readers import reading_order, source_kind

GEOMETRY = ("width", "height", "rotation", "images_count", "graphics_objects_count")


def table_status(rows: Column, ocr_text: Column, detect_only: Column) -> Column:
    """failed or fallback without rows (by whether OCR gave text), else detect or ok."""
    return case((F.coalesce(rows, F.lit(0)) > 0, F.when(detect_only, "detect").otherwise("ok")), (F.coalesce(ocr_text, F.lit("")) != "", "fallback"), default="failed")


def table_counts(tables: DataFrame) -> DataFrame:
    """(doc_id, tables, pages): how many tables have a usable status (detected ones count), and the pages of all, each once and in order."""
    return tables.groupBy("doc_id").agg(F.count_if(F.col("status").isin("ok", "detect")).alias("tables"), F.sort_array(F.collect_set("page")).alias("pages"))


def ocr_result(fallback: Column, ocr: Column) -> Column:
    """struct(text, conf, words, time_ms) of an OCR payload (text, avg_conf, tokens, time_ms): without one the fallback text with confidence 0."""
    t, plain = F.coalesce(ocr["text"], F.lit("")), F.coalesce(fallback, F.lit(""))
    zero = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    words = F.when(t != "", T.word_count(t)).otherwise(F.coalesce(ocr["tokens"], F.lit(0)).cast("int"))
    read = F.struct(t.alias("text"), zero(ocr["avg_conf"]).alias("conf"), words.alias("words"), zero(ocr["time_ms"]).alias("time_ms"))
    return F.when(ocr.isNull(), F.struct(plain.alias("text"), F.lit(0.0).alias("conf"), T.word_count(plain).alias("words"), F.lit(0.0).alias("time_ms"))).otherwise(read)


def page_blocks(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """The native blocks (doc_id, page, block, text) of pages (doc_id, page, text, decision, ocr_conf), or one block of the whole text where a page has none; with hints,
    the OCR confidence where the decision names OCR, and the reading order through the document."""
    native = blocks.select("doc_id", "page", "block", "text")
    bare = pages.join(native.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_anti").select("doc_id", "page", F.lit(0).alias("block"), "text")
    known = pages.select("doc_id", "page", F.when(F.lower("decision").contains("ocr"), F.col("ocr_conf")).alias("ocr_conf_avg"))
    b = native.unionByName(bare).withColumn("__tokens", T.words_ascii(F.coalesce("text", F.lit(""))))
    b = b.withColumns({"lang_hint": T.language_hint_of(F.col("__tokens")), "locale_hint": T.locale_hint(F.col("text"))}).drop("__tokens")
    return reading_order(b).join(known, ["doc_id", "page"], "left").withColumn("id", F.concat_ws("-", "page", "block"))


def warnings(events: DataFrame, order: str = "ts") -> DataFrame:
    """(doc_id, warnings): the codes of each document, each once, in the order in which they first came."""
    first = events.groupBy("doc_id", "code").agg(F.min(order).alias("at"))
    return first.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]).alias("warnings"))


def tool_event(details: Column) -> Column:
    """The details that go out with an event: all but texts."""
    return F.map_filter(details, lambda k, _: ~k.isin("text", "content"))


def flagged_pages(low_conf: Column, flagged: Column) -> Column:
    return F.sort_array(F.array_union(F.coalesce(low_conf, F.array().cast("array<int>")), F.coalesce(flagged, F.array().cast("array<int>"))))


def has_header_footer(zone_types: Column) -> Column:
    return F.arrays_overlap(F.transform(zone_types, F.lower), F.array(F.lit("header"), F.lit("footer")))


def fallback_page_stats(summaries: DataFrame, langs: list[str]) -> DataFrame:
    """A row of zeros for every page of summaries (doc_id, page_count, decisions) without statistics: the source follows the page's decision, the language is the first fallback."""
    lang = langs[0] if langs else "de"
    n = F.coalesce(F.nullif("page_count", F.lit(0)), F.nullif(F.size("decisions"), F.lit(0)), F.lit(1))
    s = summaries.select("doc_id", "decisions", F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("page"))
    s = s.select("doc_id", "page", F.coalesce(F.get("decisions", F.col("page") - 1), F.lit("text")).alias("decision"))
    kind = source_kind(F.col("decision"))
    zeros = {"chars": 0, "ocr_words": 0, "tables_found": 0, "table_cells": 0, "ocr_conf": 0.0, "text_density": 0.0, "noise_score": 0.0, "time_ms": 0.0, "columns_count": 1, "has_table": False, "is_multi_column": False}
    return s.withColumns({"source": F.when(kind.isin("mixed", "ocr"), kind).otherwise("text"), "lang": F.lit(lang), "locale": F.lit(lang), **{k: F.lit(v) for k, v in zeros.items()}})


def page_geometry(sources: list[DataFrame]) -> DataFrame:
    """(doc_id, page, GEOMETRY) from tables of one form, in order: a later table's figure replaces an earlier one where it has one. Pages under 1 are none."""
    rows = [s.where("page > 0").select("doc_id", "page", F.lit(i).alias("i"), *[F.col(g).cast("double").alias(g) for g in GEOMETRY]) for i, s in enumerate(sources)]
    all_ = rows[0]
    for r in rows[1:]:
        all_ = all_.unionByName(r)
    return all_.groupBy("doc_id", "page").agg(*[F.max_by(g, F.when(F.col(g).isNotNull(), F.col("i"))).alias(g) for g in GEOMETRY])


def page_list(values: Column) -> Column:
    """Whole page numbers over 0, each once, in order of appearance."""
    return F.array_distinct(F.filter(F.transform(values, lambda v: v.try_cast("int")), lambda p: p > 0))


def text_lines(lines: Column, one: Column, fallback: Column) -> Column:
    """A list of lines without nulls; else a single text; else the lines of the fallback that are not empty, or itself."""
    none, whole = F.array().cast("array<string>"), F.when(F.coalesce(fallback, F.lit("")) != "", F.array(fallback))
    of_list, of_fallback = F.array_compact(lines), F.filter(F.split(fallback, r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029]"), lambda x: x != "")
    return case(
        (lines.isNotNull() & (F.size(of_list) > 0), of_list), (lines.isNotNull(), F.coalesce(whole, none)), (F.coalesce(one, F.lit("")) != "", F.array(one)),
        (F.size(of_fallback) > 0, of_fallback), default=F.coalesce(whole, none),
    )
