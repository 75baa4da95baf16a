"""Conversions, dates, maps and JSON as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.text import case

# The timings that a summary always has, and all that it may have.
ALWAYS = ("total_ms", "text_extract_ms", "ocr_ms", "table_extract_ms")
TIMINGS = (*ALWAYS, "detect_ms", "encoding_ms", "cleaning_ms", "write_ms")


def as_int(value: Column, default: int = 0) -> Column:
    """Whole numbers and their spellings; numbers lose their fraction; anything else is the default."""
    return F.coalesce(value.try_cast("int"), F.lit(default))


def as_float(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(default))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def rfc1123(ts: Column) -> Column:
    return F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def run_id(ts: Column, seed: Column) -> Column:
    """`YYYYMMDDTHHMMSS-` and eight hexadecimal digits of the seed's hash."""
    return F.concat(F.date_format(ts, "yyyyMMdd'T'HHmmss"), F.lit("-"), F.left(F.md5(seed.cast("string").cast("binary")), F.lit(8)))


def without_volatile(json: Column, keys: tuple[str, ...] = ("timestamp", "timestamps", "created_at", "updated_at", "run_id", "trace_id", "span_id", "uuid")) -> Column:
    """A JSON text with its volatile top-level members left out and every ISO time masked, for comparison with a stored one."""
    for k in keys:
        json = F.regexp_replace(json, rf'"{k}": *("[^"]*"|[^,}}\]]*),? *', "")
    masked = F.regexp_replace(json, r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})?", "<ts>")
    return F.regexp_replace(masked, r", *\}", "}")


def version_marker(json: Column, paths: tuple[str, ...] = ("$.versioning.schema_version", "$.schema_version", "$.meta.version")) -> Column:
    """The first of the places of a JSON text that holds a version."""
    return F.coalesce(*[F.get_json_object(json, p) for p in paths])


def merged_timings(own: Column, over: Column) -> Column:
    """Known timings of two maps that are not negative, the second winning; the four that are always there default to 0."""
    known = lambda m: F.map_filter(m, lambda k, v: k.isin(list(TIMINGS)) & (v >= 0))
    zero = F.create_map(*[x for k in ALWAYS for x in (F.lit(k), F.lit(0.0))])
    pick = lambda k: F.coalesce(F.try_element_at(known(over), k), F.try_element_at(known(own), k), F.try_element_at(zero, k))
    names = F.array_distinct(F.concat(F.map_keys(known(over)), F.map_keys(known(own)), F.map_keys(zero)))
    return F.map_from_entries(F.transform(F.sort_array(names), lambda k: F.struct(k.alias("key"), F.round(pick(k), 2).alias("value"))))


def public_details(details: Column) -> Column:
    """A map without the texts it may carry."""
    return F.map_filter(details, lambda k, v: ~k.isin("text", "content"))


def commit_kind(subject: Column) -> Column:
    """major, minor, patch: what a commit's subject calls for."""
    s = F.lower(F.coalesce(subject, F.lit("")))
    return case((s.contains("breaking change") | s.rlike(r"^[a-z]+(\([^)]*\))?!:"), "major"), (s.rlike(r"^feat(\([^)]*\))?:"), "minor"), default="patch")
