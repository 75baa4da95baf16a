"""Encodings and newlines of file contents (binary columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.detect import extension
from folio.functions.text import case

#: All of a file: its contents are in memory anyway, and a part may end within a character.
SAMPLE_BYTES = 2**31 - 1


def has_bom(content: Column) -> Column:
    return F.coalesce(F.substring(F.hex(F.substring(content, 1, 3)), 1, 6) == "EFBBBF", F.lit(False))


def is_utf8(content: Column, sample: int = SAMPLE_BYTES) -> Column:
    """Whether the sample is UTF-8 as it stands; a character that the sample's end cuts makes it false."""
    return F.is_valid_utf8(F.substring(content, 1, sample).cast("string"))


def encoding_name(name: Column) -> Column:
    n = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[-_]", "")
    return case((n.isin("", "ascii", "usascii", "utf8", "utf8sig"), "utf-8"), (n.isin("latin1", "iso88591", "cp1252", "windows1252"), "iso-8859-1"), default=n)


def detect(content: Column, sample: int = SAMPLE_BYTES) -> Column:
    """struct(encoding, confidence, bom, is_utf8, sample_len): byte order mark, then UTF-8, else Latin-1 as a guess. Statistical detection is a plug-in's job."""
    bom, utf8 = has_bom(content), is_utf8(content, sample)
    return F.struct(
        F.when(bom | utf8, F.lit("utf-8")).otherwise(F.lit("iso-8859-1")).alias("encoding"), case((bom, 1.0), (utf8, 0.99), default=0.5).alias("confidence"),
        bom.alias("bom"), utf8.alias("is_utf8"), F.least(F.length(content), F.lit(sample)).alias("sample_len"),
    )


def newlines(text: Column, policy: str = "lf") -> Column:
    """One newline for CRLF and CR; CRLF for all with `crlf`."""
    lf = F.regexp_replace(F.regexp_replace(text, "\r\n", "\n"), "\r", "\n")
    return F.regexp_replace(lf, "\n", "\r\n") if policy == "crlf" else lf


def decode(content: Column, encoding: Column, policy: str = "lf") -> Column:
    """The text without byte order mark; bytes that do not fit become U+FFFD."""
    bare = F.when(has_bom(content), F.substring(content, 4, 2**31 - 1)).otherwise(content)
    text = F.when(encoding_name(encoding) == "iso-8859-1", F.decode(bare, "ISO-8859-1")).otherwise(F.make_valid_utf8(bare.cast("string")))
    return newlines(text, policy)


def normalized_path(path: Column) -> Column:
    """`name.utf8.txt` for `name.txt`; `.txt` where there is no suffix."""
    e = extension(path)
    return F.when(e == "", F.concat(path, F.lit(".utf8.txt"))).otherwise(F.concat(F.left(path, F.length(path) - F.length(e)), F.lit(".utf8"), F.right(path, F.length(e))))
