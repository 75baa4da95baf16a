"""File types, page and document votes, and parameters, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio import constants as K
from folio.functions.text import case

IMAGE_AREA, TEXT_LENGTH, WORDS, BLOCKS = 0.35, 200, 15, 3
SAMPLE_PAGES, TOP_PAGES = 5, 2


def first_path(*paths: Column) -> Column:
    """The first that is not empty."""
    return F.coalesce(*[F.nullif(p, F.lit("")) for p in paths])


def extension(path: Column) -> Column:
    """Lower-case suffix with its dot; names that begin with their only dots have none."""
    name = F.substring_index(path, "/", -1)
    return F.lower(F.regexp_extract(name, r"^\.*[^.].*?(\.[^.]*)$", 1))


def media_type(path: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in K.MEDIA.items() for x in pair])
    return F.coalesce(F.try_element_at(table, extension(path)), F.lit(""))


#: What detection recommends to the readers, beside the mode.
LANGUAGES, IMAGE_DPI, IMAGE_PSM, PDF_DPI = "deu+eng", 320, 6, 200


def file_type(path: Column) -> Column:
    """struct(file_type, ocr_recommended, confidence, mode, tables_mode, dpi, psm, ocr_lang): by suffix or media type; a PDF whose pages are not known counts as text (with page metrics: operators/detection.py)."""
    e, m = extension(path), media_type(path)
    said = lambda t, ocr, c, mode, tables="detect", dpi=None, psm=None: F.struct(
        F.lit(t).alias("file_type"), F.lit(ocr).alias("ocr_recommended"), F.lit(c).alias("confidence"), F.lit(mode).alias("mode"), F.lit(tables).alias("tables_mode"), F.lit(dpi).cast("int").alias("dpi"), F.lit(psm).cast("int").alias("psm"), F.lit(LANGUAGES).alias("ocr_lang")
    )
    text_like = m.startswith("text/") | m.contains("json") | m.contains("yaml") | m.contains("csv")
    return case(
        ((e == ".pdf") | (m == K.MEDIA[".pdf"]), said("pdf_text", False, 0.5, "native")),
        (e.isin(*K.DOCX) | (m == K.MEDIA[".docx"]), said("docx", False, 0.95, "native")),
        (e.isin(*K.TEXT) | text_like, said("txt", False, 0.95, "native", "off")),
        (e.isin(*K.IMAGE) | m.startswith("image/"), said("image", True, 0.95, "ocr", "detect", IMAGE_DPI, IMAGE_PSM)),
        default=said("unknown", False, 0.3, "mixed"),
    )


def guarded_type(path: Column, fault: Column) -> Column:
    """file_type(), or for an item with a fault (else null) an unknown type of confidence 0; and its `error`."""
    k = F.when(fault.isNull(), file_type(path))
    unknown = {"file_type": "unknown", "ocr_recommended": False, "confidence": 0.0, "mode": "mixed"}
    fields = ("file_type", "ocr_recommended", "confidence", "mode", "tables_mode", "dpi", "psm", "ocr_lang")
    return F.struct(*[(F.coalesce(k[f], F.lit(unknown[f])) if f in unknown else k[f]).alias(f) for f in fields], F.concat(F.lit("detect_failed: "), fault).alias("error"))


def page_vote(text_len: Column, words: Column, blocks: Column, images: Column, image_area: Column) -> Column:
    """struct(native_score, ocr_score, mode) of a page."""
    one = lambda c: c.cast("int")
    native = one(text_len >= TEXT_LENGTH) + one(words >= WORDS) + one(blocks >= BLOCKS)
    ocr = one(images >= 1) + one(image_area >= IMAGE_AREA) + one((text_len < TEXT_LENGTH) & (words < WORDS))
    return F.struct(native.alias("native_score"), ocr.alias("ocr_score"), case((native > ocr, "native"), (ocr > native, "ocr"), default="unclear").alias("mode"))


def document_vote(native: Column, ocr: Column, sampled: Column, largest: Column) -> Column:
    """struct(mixed, scanned, confidence) of a document: how many sampled pages vote native and ocr, of how many; the largest image share of all pages.

    A page with much image speaks for a mixed document where the votes alone do not decide."""
    said = lambda mixed, scanned, c: F.struct(F.lit(mixed).alias("mixed"), F.lit(scanned).cast("boolean").alias("scanned"), (c if isinstance(c, Column) else F.lit(c)).alias("confidence"))
    both = F.round(0.6 + 0.4 * (1 - F.abs(native - ocr) / (native + ocr).cast("double")), 3)
    return case(
        ((ocr >= sampled) & (native == 0), said(False, True, 0.9)),
        ((largest >= 0.9) & (native == 0), said(False, True, 0.9)),
        ((native > 0) & (ocr > 0), said(True, False, both)),
        (largest >= IMAGE_AREA, said(True, False, 0.7)),
        ((native >= sampled) & (ocr == 0), said(False, False, 0.9)),
        default=said(False, None, 0.5),
    )


def pdf_type(mixed: Column, scanned: Column) -> Column:
    """struct(file_type, ocr_recommended, mode, dpi) of a PDF by its vote; undecided ones count as text."""
    said = lambda t, ocr, mode, dpi: F.struct(F.lit(t).alias("file_type"), F.lit(ocr).alias("ocr_recommended"), F.lit(mode).alias("mode"), F.lit(dpi).alias("dpi"))
    return case((F.coalesce(scanned, F.lit(False)), said("pdf_scanned", True, "ocr", 320)), (mixed, said("pdf_mixed", True, "mixed", 300)), default=said("pdf_text", False, "native", 200))


def parameter(override: Column, detected: Column, configured: Column) -> Column:
    """The first that is set: override, detection, configuration."""
    return F.coalesce(override, detected, configured)


def mode(override: Column, detected: Column, configured: Column, kind: Column, confidence: Column) -> Column:
    """As parameter(), but a PDF detected with confidence under 0.7 is read as mixed."""
    unsure = F.lower(F.coalesce(kind, F.lit(""))).startswith("pdf") & (F.coalesce(confidence, F.lit(0.0)) < 0.7)
    return F.lower(F.when(unsure, F.lit("mixed")).otherwise(F.coalesce(parameter(override, detected, configured), F.lit("mixed"))))


def tables_mode(value: Column) -> Column:
    return case((value == "light", "detect"), (value == "full", "extract"), default=value)


# Names of file types where pages are read, and the unit of coordinates of each.
READER_TYPES = {"pdf_text": "pdf_text", "pdf_scanned": "pdf_scan", "pdf_scan": "pdf_scan", "pdf_mixed": "pdf_scan_hybrid", "pdf_scan_hybrid": "pdf_scan_hybrid", "docx": "docx", "image": "image", "txt": "pdf_text"}
UNITS = {"docx": "docx_emus", "image": "image_pixels"}


def reader_type(kind: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in READER_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(F.coalesce(kind, F.lit(""))))), F.lit("unknown"))


def coordinate_unit(reader: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    return F.when(reader.startswith("pdf"), "pdf_points").otherwise(F.coalesce(F.try_element_at(table, reader), F.lit("unknown")))


def option(value: Column, *off: str) -> Column:
    """A recommended value, unless it is empty or stands for none."""
    return F.when(~value.isin("", *off), value)


def forbidden(path: Column, prefixes: tuple[str, ...] = ("OneDrive/", "Desktop/", "Downloads/", "outputs/")) -> Column:
    """The first of the prefixes that a path begins with, else null."""
    return F.coalesce(*[F.when(path.startswith(p), F.lit(p)) for p in prefixes])


def route(kind: Column) -> Column:
    """Where a file goes next: text-like kinds to encoding, the rest past it."""
    return F.when(kind.isin("txt", "docx"), F.lit("encoding")).otherwise(F.lit("skip"))


def supported(path: Column, allowed: list[str]) -> Column:
    return F.substring(extension(path), 2, 100).isin([a.lower().lstrip(".") for a in allowed])


def ocr_dpi(dpi_mode: Column, dpi: Column, fonts: Column) -> Column:
    """A given resolution within 200 to 450; on `auto` by the upper median of the font sizes."""
    middle = F.get(F.sort_array(fonts), F.floor(F.size(fonts) / 2).cast("int"))
    auto = case((F.size(fonts) == 0, 350), (middle < 7.5, 400), (middle < 9.5, 350), default=300)
    return F.when(dpi_mode != "auto", F.least(F.greatest(dpi, F.lit(200)), F.lit(450))).otherwise(auto)
