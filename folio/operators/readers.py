"""Pages, blocks and documents: decisions per page, statistics, and roll-ups.

A page row has doc_id and page as its key; nothing here looks beyond one document but the stage statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.constants import Profile
from folio.functions import geometry as G
from folio.functions import text as T
from folio.functions.text import case

PROD = Profile()


# ---- pages


def text_pages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One native page per plain-text document: confidence 92 with text, else 0."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("doc_id"), F.lit(1).alias("page"), F.lit("native").alias("source"), t.alias("text"), F.when(t != "", 92.0).otherwise(0.0).alias("conf"),
        T.word_count(t).alias("words"), F.length(t).alias("chars"),
    )


def turn_pages(turns: DataFrame) -> DataFrame:
    """Multi-page documents of conversations: a turn is a page; the assistant's pages count as read by OCR."""
    t = F.coalesce("text", F.lit(""))
    words = T.word_count(t)
    return turns.select(
        F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page"), F.when(F.col("role") == "assistant", "ocr").otherwise("native").alias("source"), t.alias("text"),
        native_confidence(t, F.size(T.lines(t)), words).alias("conf"), words.alias("words"), F.length(t).alias("chars"),
    )


def native_confidence(text: Column, blocks: Column, words: Column) -> Column:
    """0 for blank text; else 55 to 96 by blocks (up to 20 for 8), words (15 for 120) and characters (10 for 1500), to two digits.

    In whole 3000ths, so that ties (to the even digit) do not hang on binary fractions."""
    parts = 165_000 + F.least(blocks, F.lit(8)) * 7_500 + F.least(words, F.lit(120)) * 375 + F.least(F.length(text), F.lit(1500)) * 20
    cents = T.let(parts.cast("int"), lambda n: F.floor(n / 30) + ((n % 30 > 15) | ((n % 30 == 15) & (F.floor(n / 30) % 2 == 1))).cast("int"))
    return F.when(F.trim(text) == "", 0.0).otherwise(F.least(cents / 100.0, F.lit(96.0)))


def needs_overlay(text: Column, conf: Column, coverage: Column, images: Column, p: Profile = PROD) -> Column:
    if not p.overlay:
        return F.lit(False)
    enough = F.lit(p.overlay_any) | ((images >= p.overlay_images) & (coverage >= p.overlay_area))
    return (images > 0) & enough & ((F.trim(text) == "") | (conf < 85))


def native_is_fine(conf: Column, words: Column, blocks: Column, coverage: Column, p: Profile = PROD) -> Column:
    return (conf != 0) & (words != 0) & (((blocks >= max(1, p.blocks)) & (conf >= p.low_conf) & (coverage < 0.6)) | ((conf >= 85) & (words > 40)))


def page_decision(mode: Column, text: Column, conf: Column, words: Column, blocks: Column, coverage: Column, images: Column, p: Profile = PROD) -> Column:
    """native, ocr or native+ocr."""
    blank, over = F.trim(text) == "", needs_overlay(text, conf, coverage, images, p)
    good = native_is_fine(conf, words, blocks, coverage, p)
    return case(
        (mode == "ocr", "ocr"), ((mode == "native") & blank, "ocr"), ((mode == "mixed") & ~good, "ocr"), (mode.isin("native", "mixed") & over, "native+ocr"), default="native"
    )


def merge_texts(native: Column, ocr: Column, native_conf: Column, ocr_conf: Column) -> Column:
    """struct(text, conf): a blank side loses; a side a quarter longer wins with the higher confidence; else the native text. Confidences to two digits."""
    said = lambda t, c: F.struct(t.alias("text"), F.bround(c, 2).alias("conf"))
    n, o, high = F.length(F.trim(native)), F.length(F.trim(ocr)), F.greatest(native_conf, ocr_conf)
    close = F.least(F.lit(99.0), F.greatest(native_conf, ocr_conf, (native_conf + ocr_conf) / 2))
    return case((n == 0, said(ocr, ocr_conf)), (o == 0, said(native, native_conf)), (o > n * 1.25, said(ocr, high)), (n > o * 1.25, said(native, high)), default=said(native, close))


def source_kind(source: Column) -> Column:
    s = F.lower(F.coalesce(source, F.lit("")))
    return case((s.contains("ocr") & (s.contains("native") | s.contains("text")), "mixed"), (s.contains("ocr"), "ocr"), (s.contains("text") | s.contains("native"), "text"), default=s)


def text_density(chars: Column, width: Column, height: Column) -> Column:
    """Characters to the area of the page, to 6 digits."""
    return F.when((chars > 0) & (width * height > 0), F.round(chars / (width * height), 6)).otherwise(F.lit(0.0))


def page_flags(source: Column, conf: Column, words: Column, chars: Column, table_failed: Column, p: Profile = PROD) -> Column:
    ocr = F.lower(source).contains("ocr")
    return F.array_compact(
        F.array(
            F.when((conf < p.low_conf) | (ocr & (conf < p.ocr_min_conf)), "low_conf_page"),
            F.when(ocr & ((words < p.low_text_words) | (chars < p.suspicious_chars)), "low_text_page"),
            F.when(table_failed, "table_extract_error"),
        )
    )


def rich_flags(given: Column, source: Column, ocr_conf: Column, ocr_words: Column, chars: Column, p: Profile = PROD) -> Column:
    """The given flags (trimmed, not empty) and those that the figures of a page call for, each once, in order."""
    own = F.array_compact(
        F.array(
            F.when(ocr_conf < p.low_conf, "low_conf_page"), F.when((ocr_conf >= p.low_conf) & (ocr_words < p.low_text_words), "low_text_page"),
            F.when((source_kind(source) == "text") & (chars < p.suspicious_chars), "suspicious_text_page"),
        )
    )
    return F.array_distinct(F.concat(F.filter(F.transform(given, lambda f: F.trim(f)), lambda f: f != ""), own))


def on_spine(pages: DataFrame, page_count: DataFrame, *others: DataFrame) -> DataFrame:
    """Every page from 1 to page_count (doc_id, n) of each document with what the page tables know of it."""
    spine = page_count.select("doc_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("page"))
    for t in (pages, *others):
        spine = spine.join(t, ["doc_id", "page"], "left")
    return spine


def with_hints(pages: DataFrame) -> DataFrame:
    """pages with lang and locale, if they have none yet. Tokens are a column of their own, so that they are made once."""
    if {"lang", "locale"} <= set(pages.columns):
        return pages
    t = pages.withColumn("__tokens", T.words_ascii(F.coalesce("text", F.lit(""))))
    return t.withColumns({"lang": T.language_hint_of(F.col("__tokens")), "locale": T.locale_hint(F.col("text"))}).drop("__tokens")


def _own_flags(p: Profile) -> Column:
    return rich_flags(F.array(), F.col("source"), F.when(F.lower("source").contains("ocr"), F.col("conf")), F.col("words"), F.col("chars"), p)


def page_stats(pages: DataFrame, p: Profile = PROD) -> DataFrame:
    """Pages with kind, hints, density on an A4 page and flags."""
    ocr = F.when(F.lower("source").contains("ocr"), F.col("conf"))
    return with_hints(pages).select(
        "doc_id", "page", source_kind(F.col("source")).alias("source"), "chars", "lang", "locale", F.coalesce(ocr, F.lit(0.0)).alias("ocr_conf"), "words",
        _own_flags(p).alias("flags"), text_density(F.col("chars"), F.lit(595.0), F.lit(842.0)).alias("text_density"),
    )


def page_report(pages: DataFrame, geometry: DataFrame, shares: DataFrame, zones: DataFrame, wide: DataFrame, fallback: str = "", p: Profile = PROD) -> DataFrame:
    """All that is told of a page, one row per row of pages (doc_id, page, source, decision, chars, lang, locale, ocr_conf, ocr_words, tables_found, table_cells, has_table, time_ms,
    skew_deg, noise_score, flags).

    geometry (doc_id, page, width, height, rotation, images_count, graphics_objects_count), shares (language_share()), zones (doc_id, page, has_header_footer) and wide
    (doc_id, page: pages of two columns) are met by page, each with a row per page at most; what is not known of a page is 0, false or, for shares, its language."""
    num = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    whole = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0))
    x = pages
    for t in (geometry, shares, zones, wide.select("doc_id", "page", F.lit(True).alias("is_multi_column"))):
        x = x.join(t, ["doc_id", "page"], "left")
    given = F.coalesce(F.nullif("source", F.lit("")), F.nullif("decision", F.lit("")), F.lit("text"))
    said = F.coalesce(F.nullif("decision", F.lit("")), given)
    lang = lambda c: T.collapse_tokens(case((F.size(T.language_tokens(F.col(c))) > 0, T.language_tokens(F.col(c))), default=T.language_tokens(F.lit(fallback))))
    x = x.withColumns({"lang": lang("lang"), "locale": lang("locale"), "source": source_kind(given), "decision": said, "is_multi_column": F.coalesce("is_multi_column", F.lit(False)), "__conf": F.bround(F.col("ocr_conf").cast("double"), 2)})
    one = lambda tag: F.coalesce(F.col(tag), F.when(F.col("lang") == "de+en", 0.5).when(F.col("lang") == tag, 1.0).otherwise(0.0))
    share = F.when(F.col("de").isNull() & F.col("en").isNull(), F.struct(one("de").alias("de"), one("en").alias("en"))).otherwise(F.struct(F.coalesce("de", F.lit(0.0)).alias("de"), F.coalesce("en", F.lit(0.0)).alias("en")))
    return x.select(
        "doc_id", "page", "source", whole("chars").alias("chars"), "lang", share.alias("lang_share"), F.coalesce("__conf", F.lit(0.0)).alias("ocr_conf"), whole("ocr_words").alias("ocr_words"),
        whole("tables_found").alias("tables_found"), whole("table_cells").alias("table_cells"), rich_flags(F.col("flags"), F.col("source"), F.col("__conf"), F.col("ocr_words"), F.col("chars"), p).alias("flags"),
        G.rotation(num("rotation")).alias("rotation_deg"), F.bround(num("skew_deg"), 2).alias("skew_deg"), "is_multi_column", F.when(F.col("is_multi_column"), 2).otherwise(1).alias("columns_count"),
        F.struct(num("width").alias("width"), num("height").alias("height")).alias("page_size"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.bround(num("noise_score"), 3))).alias("noise_score"),
        text_density(F.col("chars"), num("width"), num("height")).alias("text_density"), F.coalesce("has_header_footer", F.lit(False)).alias("has_header_footer"), (whole("images_count") > 0).alias("has_images"),
        whole("images_count").alias("images_count"), whole("graphics_objects_count").alias("graphics_objects_count"), F.bround(num("time_ms"), 2).alias("time_ms"), "locale",
        "decision", (F.coalesce("has_table", F.lit(False)) | (whole("tables_found") > 0)).alias("has_table"),
    )


# ---- blocks


def line_blocks(pages: DataFrame) -> DataFrame:
    """A block for each line of a page that is not blank, with style; reading_order runs through the document in page order."""
    b = pages.select("doc_id", "page", F.posexplode(T.lines(F.col("text"))).alias("block", "text"))
    head, listed = T.heading_like(F.col("text"), F.lit(1)), T.list_like(F.col("text"))
    return b.select(
        "doc_id", "page", F.concat_ws("-", "page", "block").alias("id"), "text", F.length("text").alias("char_count"), T.token_count(F.col("text")).alias("token_count"),
        head.alias("is_heading_like"), listed.alias("is_list_like"), T.is_upper(F.col("text")).alias("is_upper"), T.numbering_marker(F.col("text")).alias("numbering_marker"),
        T.paragraph_style(head, listed).alias("paragraph_style"), F.when(listed, 1).otherwise(0).alias("list_level"), "block",
    )


def reading_order(blocks: DataFrame) -> DataFrame:
    """Numbers the blocks of a document from 0: the blocks of the pages before, then the place in the page. Only counts per page are
    brought together for a document, not its blocks."""
    from pyspark.sql import Window

    per_page = blocks.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    before = per_page.select("doc_id", "page", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    return blocks.join(before, ["doc_id", "page"]).withColumn("reading_order_index", F.col("before") + F.col("block")).drop("before")


def language_share(blocks: DataFrame, fallback: list[str] | None = None) -> DataFrame:
    """(doc_id, page, de, en): characters of each language's blocks to all that have one, to 4 digits. A block counts for the tags of its hint, else for those
    of `fallback`, else by the scripts of its words; with several tags in equal parts."""
    b = blocks.select("doc_id", "page", "text", F.length("text").alias("chars"), T.words_ascii(F.col("text")).alias("tokens"))
    b = b.select("doc_id", "page", "chars", "text", T.language_hint_of(F.col("tokens")).alias("hint"))
    if fallback:
        other = F.array(*map(F.lit, fallback))
    else:
        b = b.withColumn("s", F.when(F.col("hint") == T.UNKNOWN, T.script_counts(F.col("text"))))
        other = F.array_compact(F.array(F.when(F.col("s.de") > 0, "de"), F.when(F.col("s.en") > 0, "en")))
    tags = case((F.col("hint") == T.MIXED, F.array(F.lit("de"), F.lit("en"))), (F.col("hint") == T.UNKNOWN, other), default=F.array("hint"))
    # Blocks without a tag are left out of the sums: a filter here would be pushed below, and the tokens made again for it.
    b = b.select("doc_id", "page", "chars", tags.alias("tags"))
    of = lambda t: F.sum(F.when(F.array_contains("tags", t), F.col("chars") / F.size("tags")).otherwise(0.0))
    g = b.groupBy("doc_id", "page").agg(of("de").alias("de"), of("en").alias("en"), F.sum(F.when(F.size("tags") > 0, F.col("chars"))).alias("all"))
    return g.where("all > 0").select("doc_id", "page", *[F.round(F.col(t) / F.col("all"), 4).alias(t) for t in ("de", "en")])


# ---- documents


def safe_average(value: Column) -> Column:
    """The mean of values over 0, else 0."""
    v = value.try_cast("double")
    return F.coalesce(F.avg(F.when(v > 0, v)), F.lit(0.0))


def document_summary(pages: DataFrame, p: Profile = PROD, *more: Column) -> DataFrame:
    """Roll-up of a document's pages: counts, confidences, decisions in page order, hints, flagged pages and whether it needs review (many flagged pages, or any warning,
    if pages have a column `warnings`: how many); and `more` aggregates."""
    low = (F.col("conf") < p.low_conf) | (F.lower("source").contains("ocr") & (F.col("conf") < p.ocr_min_conf))
    ocr = F.lower("source").contains("ocr")
    x = with_hints(pages).withColumn("low", low)
    first_locale = F.min_by(F.when(~F.col("locale").isin("unknown", "mixed"), F.col("locale")), F.when(~F.col("locale").isin("unknown", "mixed"), F.col("page")))
    if "warnings" in pages.columns:
        more = (*more, F.coalesce(F.sum("warnings"), F.lit(0)).alias("__warnings"))
    out = x.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("page_count"), F.sum("words").alias("words"), F.sum("chars").alias("chars"), safe_average(F.col("conf")).alias("avg_conf"),
        F.coalesce(F.avg(F.when(ocr, F.col("conf"))), F.lit(0.0)).alias("avg_ocr_conf"), F.max(ocr).alias("has_ocr"), T.merged_hint(F.col("lang")).alias("lang_hint"),
        F.coalesce(first_locale, F.lit("unknown")).alias("locale"), F.sort_array(F.collect_list(F.struct("page", "source"))).alias("decisions"), F.sum(F.col("low").cast("int")).alias("low_pages"), *more,
    )
    warned = F.col("__warnings") > 0 if "warnings" in pages.columns else F.lit(False)
    review = (F.col("low_pages") / F.col("page_count") >= p.review_ratio) | warned
    return out.withColumn("decisions", F.col("decisions.source")).withColumn("needs_review", review).drop("__warnings")


def document_language(pages: DataFrame) -> DataFrame:
    """(doc_id, lang): the tags of all pages put together; de without any."""
    tags = with_hints(pages).select("doc_id", T.language_tokens(F.col("lang")).alias("tags"))
    found = tags.groupBy("doc_id").agg(F.flatten(F.collect_set("tags")).alias("tags"))
    return found.select("doc_id", T.collapse_tokens(F.array_distinct("tags")).alias("lang"))


def document_meta(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """One nested row per document: summary, pages in order, and headings in reading order."""
    heads = blocks.where("is_heading_like").groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("page", "block", "text"))), lambda b: b["text"]).alias("headings"))
    listed = F.sort_array(F.collect_list(F.struct("page", source_kind(F.col("source")).alias("source"), "chars", "lang", _own_flags(PROD).alias("flags")))).alias("pages")
    return document_summary(pages, PROD, listed).join(heads, "doc_id", "left")


def stage_stats(summaries: DataFrame) -> DataFrame:
    return summaries.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.avg("avg_conf"), F.lit(0.0)).alias("avg_conf"), F.coalesce(F.sum("page_count"), F.lit(0)).alias("pages"), F.sum(F.col("needs_review").cast("long")).alias("to_review"))
