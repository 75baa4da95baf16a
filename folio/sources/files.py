"""Sources: files, text, DOCX, JSON lines, and an interface for readers that need other libraries."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import detect, encoding
from folio.functions import text as T
from folio.sources import pdf

PAGES = "path string, page int, source string, text string, conf double, words int, chars int"
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def paths(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items with `path`, those that name none): the first of path, file_path and source_path that is there and not empty."""
    named = [F.col(c) for c in ("path", "file_path", "source_path") if c in items.columns]
    x = items.withColumn("path", detect.first_path(*named))
    return x.where("path is not null"), x.where("path is null").withColumn("reason", F.lit("missing_path"))


def binary(spark: SparkSession, inputs: list[str]) -> DataFrame:
    """path, modificationTime, length, content of files, folders or globs; no input is an error, as is one that is not there."""
    if not inputs:
        raise ValueError("no inputs")
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(inputs)


def text_pages(files: DataFrame) -> DataFrame:
    """One page per text file (PAGES), decoded as detected; bytes that do not fit become U+FFFD."""
    t = encoding.decode(F.col("content"), encoding.detect(F.col("content"))["encoding"])
    x = files.select("path", t.alias("text"))
    return x.select("path", F.lit(1).alias("page"), F.lit("native").alias("source"), "text", F.when(F.col("text") != "", 92.0).otherwise(0.0).alias("conf"), T.word_count(F.col("text")).alias("words"), F.length("text").alias("chars"))


def docx_text(content: bytes) -> str:
    """Paragraphs that are not blank, then table rows with their cells joined by ` | `."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{WORD}body")
    said = lambda e: "".join(t.text or "" for t in e.iter(f"{WORD}t"))
    parts = [p for p in (said(p).rstrip() for p in body.findall(f"{WORD}p")) if p.strip()]
    for row in body.iter(f"{WORD}tr"):
        cells = [said(c).strip() for c in row.findall(f"{WORD}tc")]
        if any(cells):
            parts.append(" | ".join(cells))
    return "\n".join(parts)


def _docx(files: DataFrame) -> DataFrame:
    """(path, text, error) of each DOCX file: a file that cannot be read has its error and an empty text, and stops nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, errors = [], []
            for c in b.column(1).to_pylist():
                try:
                    out.append(docx_text(c))
                    errors.append(None)
                except Exception as e:  # whatever a broken file does to its readers is that file's own
                    out.append("")
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(errors, pa.string())], names=["path", "text", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, text string, error string")


def docx_pages(files: DataFrame) -> DataFrame:
    """One page per DOCX file, confidence 90; a file that cannot be read gives an empty page of confidence 0 (its error: read_faults())."""
    x = _docx(files)
    return x.select("path", F.lit(1).alias("page"), F.lit("native").alias("source"), "text", F.when(F.col("text") != "", 90.0).otherwise(0.0).alias("conf"), T.word_count(F.col("text")).alias("words"), F.length("text").alias("chars"))


def read_faults(files: DataFrame) -> DataFrame:
    """(path, error) of the files that their reader could not read, or not every page of."""
    typed = files.withColumn("kind", detect.file_type(F.col("path"))["file_type"])
    return _docx(typed.where("kind = 'docx'")).where("error is not null").select("path", "error").unionByName(pdf.faults(typed.where("kind = 'pdf_text'")))


#: kind -> function of (files with path and content) giving PAGES; readers of images register here.
READERS: dict[str, Callable[[DataFrame], DataFrame]] = {"txt": text_pages, "docx": docx_pages, "pdf_text": pdf.pages}


def register(kind: str, reader: Callable[[DataFrame], DataFrame]) -> None:
    READERS[kind] = reader


def read_pages(files: DataFrame) -> DataFrame:
    """The pages of all files whose kind has a reader; see unread() for the rest."""
    typed = files.withColumn("kind", detect.file_type(F.col("path"))["file_type"])
    parts = [reader(typed.where(F.col("kind") == kind)) for kind, reader in READERS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unread(files: DataFrame) -> DataFrame:
    """(path, kind, reason) of files without a reader: they are reported, never guessed."""
    typed = files.select("path", detect.file_type(F.col("path"))["file_type"].alias("kind"))
    return typed.where(~F.col("kind").isin(list(READERS))).withColumn("reason", F.concat(F.lit("no_reader:"), F.col("kind")))


def ocr_words(dumps: DataFrame) -> DataFrame:
    """A row per word of the dumps of an OCR engine (columns of dumps but tsv, which is text: a heading and rows of twelve cells parted by tabs): line (of the dump), block, par, row, word, conf, text.

    Blank rows and rows of fewer than eleven cells are none; a confidence that is no number is null."""
    keys = [c for c in dumps.columns if c != "tsv"]
    lines = F.slice(F.split(F.coalesce("tsv", F.lit("")), r"\r\n|\n|\r"), 2, 2**31 - 1)
    x = dumps.select(*keys, F.posexplode(lines).alias("line", "__row")).where("trim(__row) <> ''").withColumn("__c", F.split("__row", "\t")).where(F.size("__c") > 10)
    number = lambda i: F.get("__c", F.lit(i)).try_cast("int")
    conf = F.trim(F.get("__c", F.lit(10))).try_cast("double")
    return x.select(*keys, "line", number(2).alias("block"), number(3).alias("par"), number(4).alias("row"), number(5).alias("word"), F.when(~F.isnan(conf), conf).alias("conf"), F.coalesce(F.get("__c", F.lit(11)), F.lit("")).alias("text"))


def ocr_pages(dumps: DataFrame) -> DataFrame:
    """(columns of dumps but tsv, text, avg_conf, words): the words of a page, row by row, and the mean of the confidences that are not negative (two digits; null if there are none)."""
    keys = [c for c in dumps.columns if c != "tsv"]
    said = F.col("text") != ""
    rows = ocr_words(dumps).groupBy(*keys, "block", "par", "row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(said, F.struct("line", "text")))), lambda w: w["text"]), " ").alias("text"), F.min("line").alias("line"),
        F.sum(F.when(F.col("conf") >= 0, F.col("conf"))).alias("conf"), F.count_if(F.col("conf") >= 0).alias("n"), F.count_if(said).alias("words"),
    )
    lines = F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("line", "text"))))
    pages = rows.groupBy(*keys).agg(F.array_join(F.transform(lines, lambda r: r["text"]), "\n").alias("text"), F.round(F.try_divide(F.sum("conf"), F.sum("n")), 2).alias("avg_conf"), F.sum("words").alias("words"))
    none = dumps.select(*keys).join(pages.select(*keys), keys, "left_anti").withColumns({"text": F.lit(""), "avg_conf": F.lit(None).cast("double"), "words": F.lit(0).cast("long")})
    return pages.unionByName(none)


def json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Objects of JSON lines of a given schema; blank and broken lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def unified_text(pages: DataFrame) -> DataFrame:
    """(doc_id, text): the texts of a document's pages in order, one after the other."""
    sorted_ = F.sort_array(F.collect_list(F.struct("page", "text")))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(sorted_, lambda p: p["text"]), "\n").alias("text"))
