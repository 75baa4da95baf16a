"""Text functions as column expressions: language and locale hints, tokens, structure of lines, redaction."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from folio import constants as K

UNKNOWN, MIXED = "unknown", "mixed"


def _case(*pairs: tuple[Column, object], default: object = None) -> Column:
    """The value of the first condition that holds."""
    first, *rest = pairs
    c = reduce(lambda c, p: c.when(p[0], p[1]), rest, F.when(first[0], first[1]))
    return c if default is None else c.otherwise(default)


case = _case


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def words_ascii(text: Column) -> Column:
    """Lower-case tokens of the ASCII letters and digits; everything else separates."""
    return F.array_remove(F.split(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")), " "), "")


def language_hint_of(tokens: Column) -> Column:
    """de, en, mixed or unknown from token counts: German words or letter pairs against English words, a month name adding one to its side."""
    known = lambda ws: F.array(*map(F.lit, ws))
    has_pair = lambda w: reduce(Column.__or__, [F.contains(w, F.lit(p)) for p in K.GERMAN_PAIRS])
    count = lambda hit: F.size(F.filter(tokens, hit))
    month = lambda ws: F.arrays_overlap(tokens, known(ws)).cast("int")
    de = count(lambda w: w.isin(K.GERMAN_WORDS) | has_pair(w)) + month(K.GERMAN_MONTHS)
    en = count(lambda w: w.isin(K.ENGLISH_WORDS)) + month(K.ENGLISH_MONTHS)

    def decide(n: Column) -> Column:
        d, e = n["de"], n["en"]
        return _case(((d == 0) & (e == 0), UNKNOWN), ((d > 0) & (e > 0) & (F.abs(d - e) <= 1), MIXED), (d > e, "de"), default="en")

    # The counts are bound once: written out, each branch would count again.
    counts = F.struct(F.coalesce(de, F.lit(0)).alias("de"), F.coalesce(en, F.lit(0)).alias("en"))
    return let(counts, decide)


def language_hint(text: Column) -> Column:
    return language_hint_of(words_ascii(F.coalesce(text, F.lit(""))))


def locale_hint(text: Column) -> Column:
    """de, en, mixed or unknown from the formats of dates and amounts."""
    t = F.coalesce(text, F.lit(""))
    de, en = t.rlike(K.GERMAN_DATE) | t.rlike(K.GERMAN_AMOUNT), t.rlike(K.ENGLISH_DATE) | t.rlike(K.ENGLISH_AMOUNT)
    return let(F.struct(de.alias("de"), en.alias("en")), lambda f: _case((f["de"] & f["en"], MIXED), (f["de"], "de"), (f["en"], "en"), default=UNKNOWN))


def merge_hints(a: Column, b: Column) -> Column:
    """unknown gives way, equal stays, different is mixed."""
    a, b = F.coalesce(F.nullif(a, F.lit("")), F.lit(UNKNOWN)), F.coalesce(F.nullif(b, F.lit("")), F.lit(UNKNOWN))
    return _case((a == UNKNOWN, b), (b == UNKNOWN, a), (a == b, a), default=MIXED)


def merged_hint(hint: Column) -> Column:
    """Aggregate form of merge_hints(): the merge does not depend on order, so least and greatest known hint decide."""
    known = F.when(hint != UNKNOWN, hint)
    lo, hi = F.min(known), F.max(known)
    return _case((lo.isNull(), UNKNOWN), (lo == hi, lo), default=MIXED)


def language_tag(tag: Column) -> Column:
    t = F.trim(F.lower(F.coalesce(tag, F.lit(""))))
    return _case((t.isin("de", "ger", "deu"), "de"), (t.isin("en", "eng"), "en"), default=t)


def collapse_shares(de: Column, en: Column) -> Column:
    return _case(((de > 0.8) & (en < 0.2), "de"), ((en > 0.8) & (de < 0.2), "en"), default="de+en")


def script_counts(text: Column) -> Column:
    """struct(en, de): words of ASCII letters only, other words."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)\w+"), F.lit(0))
    ascii_ = F.size(F.filter(words, lambda w: w.rlike(r"^[\x00-\x7F]*$")))
    return F.struct(ascii_.alias("en"), (F.size(words) - ascii_).alias("de"))


def language_tokens(value: Column) -> Column:
    """Distinct tags of a list written with commas or pluses; mixed stands for both; only de and en remain."""
    parts = F.split(F.replace(F.coalesce(value, F.lit("")), F.lit(","), F.lit("+")), r"\+")
    tags = F.transform(parts, language_tag)
    spread = F.flatten(F.transform(tags, lambda t: F.when(t == MIXED, F.array(F.lit("de"), F.lit("en"))).otherwise(F.array(t))))
    return F.array_distinct(F.filter(spread, lambda t: t.isin("de", "en")))


def collapse_tokens(tokens: Column) -> Column:
    return _case((F.size(tokens) == 0, "de"), (F.size(tokens) == 1, F.get(tokens, 0)), default="de+en")


def resolve_language(raw: Column, fallback: Column, text: Column) -> Column:
    """The tags of raw, else of fallback, else by script of the text, else de."""
    by_script = script_counts(text)
    own, other = language_tokens(raw), language_tokens(fallback)
    script = F.concat(F.when(by_script["de"] > 0, F.array(F.lit("de"))).otherwise(F.array()), F.when(by_script["en"] > 0, F.array(F.lit("en"))).otherwise(F.array()))
    return collapse_tokens(_case((F.size(own) > 0, own), (F.size(other) > 0, other), default=script))


def language_confidence(lang: Column) -> Column:
    return _case((F.coalesce(lang, F.lit("")) == "", 0.0), (lang == "de+en", 0.7), (lang.isin("de", "en"), 0.95), default=0.5)


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def token_count(text: Column) -> Column:
    return word_count(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" ")))


def lines(text: Column) -> Column:
    """Trimmed lines that are not blank."""
    parts = F.split(F.coalesce(text, F.lit("")), r"\R")
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, r"^(?U)\s+|\s+$", "")), lambda p: p != "")


def block_text(text: Column) -> Column:
    return F.array_join(lines(text), "\n")


def upper_ratio(text: Column) -> Column:
    """Upper-case letters to letters; 0 without letters."""
    upper = F.regexp_count(text, F.lit(r"\p{Lu}"))
    return let(F.regexp_count(text, F.lit(r"\p{L}")), lambda n: F.when(n > 0, upper / n).otherwise(F.lit(0.0)))


def is_upper(text: Column) -> Column:
    return upper_ratio(text) >= 0.75


def heading_like(text: Column, n_lines: Column, largest_font: Column | None = None, mean_font: Column | None = None) -> Column:
    """Few words, mostly in capitals, or a single short line with capitals, or a large font."""
    t = F.trim(F.coalesce(text, F.lit("")))
    large = F.lit(False) if largest_font is None else F.coalesce(largest_font >= F.greatest(F.lit(14.0), mean_font * 1.2), F.lit(False)) & (largest_font > 0)
    # Words are counted once, capitals only where there are few.
    capitals = lambda n: let(upper_ratio(t), lambda r: ((r >= 0.6) & (n <= 8)) | large | ((n_lines == 1) & (n <= 6) & (r >= 0.4)))
    return (t != "") & let(word_count(t), lambda n: (n <= 12) & capitals(n))


def list_like(text: Column, compat: bool = False) -> Column:
    """A bullet, or a number or letter with ) or . before white space. compat: bullets only (a known misprint never matches numbers)."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+", "")
    bullet = t.rlike("^([-*+] |•)")
    return bullet if compat else bullet | t.rlike(r"^([0-9]+|[a-zA-Z])[).]\s")


def numbering_marker(text: Column) -> Column:
    """The bullet, or the first two characters of `1.`, `1)`, `a.`, `a)` if more follows; else empty. The bell character counts as a bullet."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+", "")
    return _case((t.rlike("^[-*+] "), F.substring(t, 1, 1)), (t.rlike("^\u0007"), "\u0007"), (t.rlike(r"(?s)^[\p{Nd}\p{L}][.)]."), F.substring(t, 1, 2)), default="")


def paragraph_style(heading: Column, is_list: Column) -> Column:
    return _case((heading, "heading"), (is_list, "list"), default="body")


def bool_flag(value: Column, default: bool = False) -> Column:
    v = F.lower(F.trim(value.cast("string")))
    return _case((v.isin("true", "1", "yes"), True), (v.isin("false", "0", "no"), False), default=default)


def redact(text: Column) -> Column:
    return reduce(lambda t, p: F.regexp_replace(t, p, K.REDACTED), K.SECRET_PATTERNS, text)


def redact_value(key: str, value: Column, salt: str = "") -> Column:
    """Open keys stay, hashed keys become SHA-256 of salt and value, secret keys are replaced, other strings are searched."""
    k = key.lower()
    if k in K.OPEN_KEYS:
        return value
    if k in K.HASHED_KEYS:
        return F.when(value.isNotNull(), F.sha2(F.concat(F.lit(salt), value.cast("string")), 256))
    if k in K.SECRET_KEYS:
        return F.when(value.isNotNull(), F.lit(K.REDACTED))
    return redact(value)


def truncated(value: Column, most: int = 4096) -> tuple[Column, Column]:
    """(the value cut to `most` characters, whether it was cut)"""
    return F.left(value, F.lit(most)), F.coalesce(F.length(value) > most, F.lit(False))


def trace_url(template: Column, trace_id: Column) -> Column:
    """The template with {trace_id} filled in; null without either."""
    return F.when((F.trim(template) != "") & (trace_id != ""), F.replace(F.trim(template), F.lit("{trace_id}"), trace_id))


def nfc(text: Column) -> Column:
    """The text in normal form C, Arrow batches at a time: no built-in function does it."""

    @F.arrow_udf("string")
    def run(v: pa.Array) -> pa.Array:
        return pa.array([x if x is None or x.isascii() else unicodedata.normalize("NFC", x) for x in v.to_pylist()], pa.string())

    return run(text)


def summary_line(step: Column, status: Column, page: Column, details: Column) -> Column:
    """`step status [p=n] k=v, ...` with the keys of the map in order."""
    pairs = F.array_join(F.transform(F.sort_array(F.map_entries(details)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")
    return F.concat_ws(" ", step, status, F.when(page.isNotNull(), F.concat(F.lit("[p="), page.cast("string"), F.lit("]"))), F.when(pairs != "", pairs))


def semver(version: Column) -> Column:
    """struct(major, minor, patch), null if it is none."""
    ok = version.rlike(r"^v?[0-9]+\.[0-9]+\.[0-9]+$")
    part = lambda i: F.regexp_extract(version, r"^v?([0-9]+)\.([0-9]+)\.([0-9]+)$", i).cast("int")
    return F.when(ok, F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch")))


def bump(version: Column, kind: Column) -> Column:
    v = semver(version)
    dotted = lambda a, b, c: F.concat_ws(".", a, b, c)
    return _case((kind == "major", dotted(v["major"] + 1, F.lit(0), F.lit(0))), (kind == "minor", dotted(v["major"], v["minor"] + 1, F.lit(0))), (kind == "patch", dotted(v["major"], v["minor"], v["patch"] + 1)))


def bump_kind(old: Column, new: Column) -> Column:
    a, b = semver(old), semver(new)
    return _case((b["major"] > a["major"], "major"), (b["minor"] > a["minor"], "minor"), (b["patch"] > a["patch"], "patch"), default="none")
