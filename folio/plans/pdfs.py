"""Queries of PDF files that are written from whole tables in three layouts and read back."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import detection
from folio.plans.registry import _SAMPLE, _lines, _words, query
from folio.plans.views import table
from folio.sources import pdf

#: Pages are 1,000 units wide and high.
SIDE = 1000


def _stream(keys: str, data: bytes, pack: bool) -> bytes:
    data = zlib.compress(data, 1) if pack else data
    return f"<< {keys} /Length {len(data)}{' /Filter /FlateDecode' if pack else ''} >>\nstream\n".encode() + data + b"\nendstream"


def document(pages: list[dict], layout: int) -> bytes:
    """A PDF of pages (lines, areas: hundredths of the page that each image covers). Layout 0: single-byte text as it is, and an older version of each page before it; 1: packed, two-byte codes with a map, a tree of
    two levels; 2: like 1 with all but streams inside an object stream, and the text of a page in two streams. What cp1252 lacks is never written in layout 0, but in 1."""
    said = "".join(line for p in pages for line in p["lines"])
    try:
        said.encode("cp1252")
    except UnicodeEncodeError:
        layout = layout or 1
    codes = {c: i + 1 for i, c in enumerate(sorted(set(said)))}

    def string(line: str) -> bytes:
        if layout:
            return b"<" + b"".join(b"%04x" % codes[c] for c in line) + b">"
        return b"(" + b"".join(b"\\" + bytes([c]) if c in b"()\\" else bytes([c]) if 32 <= c < 127 else b"\\%03o" % c for c in line.encode("cp1252")) + b")"

    made: dict[int, bytes] = {}
    plain: dict[int, bytes] = {}
    number = 10
    kids = []
    for p in pages:
        pictures = b"".join(b"q %d 0 0 %d 0 0 cm /Im0 Do Q\n" % (SIDE, a * SIDE // 100) if a == int(a) else b"q %d 0 0 %d 0 0 cm /Im0 Do Q\n" % (SIDE // 2, int(a * 2) * SIDE // 100) for a in p["areas"])
        texts = [b"BT /F1 10 Tf 50 %d Td %s Tj ET\n" % (SIDE - 12 * (i + 1), string(line)) for i, line in enumerate(p["lines"])]
        half = len(texts) // 2 if layout == 2 else len(texts)
        made[number + 1] = _stream("", pictures + b"".join(texts[:half]), layout > 0)
        made[number + 2] = _stream("", b"".join(texts[half:]), layout > 0)
        xobjects = " ".join(f"/Im{i} 4 0 R" for i in range(len(p["areas"])))
        contents = f"[{number + 1} 0 R {number + 2} 0 R]" if layout == 2 else f"{number + 1} 0 R"
        plain[number] = f"<< /Type /Page /Parent 2 0 R /Contents {contents} /Resources << /Font << /F1 3 0 R >> /XObject << {xobjects} >> >> >>".encode()
        kids.append(f"{number} 0 R")
        number += 3
    groups = [kids]
    if layout:
        groups = [kids[i : i + 2] for i in range(0, len(kids), 2)]
        for g in groups:
            plain[number] = f"<< /Type /Pages /Count {len(g)} /Kids [{' '.join(g)}] >>".encode()
            number += 1
    top = kids if not layout else [f"{number - len(groups) + i} 0 R" for i in range(len(groups))]
    plain[1] = b"<< /Type /Catalog /Pages 2 0 R >>"
    plain[2] = f"<< /Type /Pages /Count {len(kids)} /MediaBox [0 0 {SIDE} {SIDE}] /Kids [{' '.join(top)}] >>".encode()
    made[4] = _stream("/Type /XObject /Subtype /Image /Width 1 /Height 1", b"1 0 obj << /Type /Catalog >> endobj", False)
    if layout:
        plain[3] = b"<< /Type /Font /Subtype /Type0 /Encoding /Identity-H /ToUnicode 5 0 R >>"
        rows = b"\n".join(b"<%04x> <%s>" % (i, c.encode("utf-16-be").hex().encode()) for c, i in codes.items())
        made[5] = _stream("", b"/CMapName /X def 1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar\n" + rows + b"\nendbfchar endcmap", True)
    else:
        plain[3] = b"<< /Type /Font /Subtype /Type1 /Encoding /WinAnsiEncoding >> % the one (font"
    if layout == 2:
        head, body = [], b""
        for n, o in plain.items():
            head.append(f"{n} {len(body)}")
            body += o + b" "
        first = " ".join(head).encode() + b" "
        made[6] = _stream(f"/Type /ObjStm /N {len(plain)} /First {len(first)}", first + body, True)
    else:
        made |= plain
    older = b"".join(b"%d 0 obj << /Type /Page >> endobj\n" % n for n in plain if n >= 10) if not layout else b""
    return b"%PDF-1.7\n" + older + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, o) for n, o in made.items()) + b"trailer << /Root 1 0 R >>\n%%EOF\n"


def written(pages: Column, layout: Column) -> Column:
    """document() of each row's pages."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for p, n in batches:
            yield pa.array([document(x, y) for x, y in zip(p.to_pylist(), n.to_pylist())], pa.binary())

    return run(pages, layout)


def _runs(items: Column, size: int) -> Column:
    """An array cut into arrays of `size`; an empty one gives none."""
    return F.when(F.size(items) == 0, F.array().cast("array<array<string>>")).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int")), lambda i: F.slice(items, i * size + 1, size)))


def _documents(spark, d) -> DataFrame:
    """The words of every document, ten a line and forty lines a page, as files."""
    x = table(spark, d, "documents").select("doc_id", F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("w"))
    x = x.select("doc_id", F.transform(_runs(F.col("w"), 10), lambda w: F.array_join(w, " ")).alias("lines"))
    leaves = F.when(F.size("lines") == 0, F.array(F.array().cast("array<string>"))).otherwise(_runs(F.col("lines"), 40))
    pages = F.transform(leaves, lambda p: F.struct(p.alias("lines"), F.array().cast("array<double>").alias("areas")))
    return x.select(F.col("doc_id").cast("string").alias("path"), written(pages, (F.col("doc_id") % 3).cast("int")).alias("content"))


@query(r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w, generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), 1) AS i FROM documents)
SELECT doc_id, ((i - 1) // 400 + 1)::INT AS page, ltrim(string_agg(CASE WHEN i % 10 = 1 THEN chr(10) ELSE ' ' END || w, '' ORDER BY i), chr(10)) AS text FROM w GROUP BY doc_id, (i - 1) // 400
UNION ALL SELECT doc_id, 1, '' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM w)""")
def pdf_pages(spark, d):
    return pdf.pages(_documents(spark, d)).select(F.col("path").cast("long").alias("doc_id"), "page", "text")


_FROM = _SAMPLE[: _SAMPLE.index("s AS (")]
_READ = f"""c AS (SELECT conv_id AS doc_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS turn, coalesce(text, '') AS text FROM conversations),
v AS (SELECT doc_id, turn, length(array_to_string({_lines("text")}, chr(10))) AS len, {_words("text")} AS words, len({_lines("text")}) AS blocks, (doc_id + turn) % 3 AS images,
  CASE WHEN (doc_id + turn) % 3 = 0 THEN 0 ELSE ((doc_id * 7 + turn * 31) % 101) / 100.0 END::DOUBLE AS area FROM c), """


@query(f"""WITH {_READ}{_SAMPLE[len(_FROM) :]} SELECT doc_id, pages, sampled, CASE WHEN scanned THEN 'pdf_scanned' WHEN mixed THEN 'pdf_mixed' ELSE 'pdf_text' END AS file_type, CASE WHEN scanned THEN 'ocr' WHEN mixed THEN 'mixed' ELSE 'native' END AS mode, confidence FROM d""")
def pdf_file_types(spark, d):
    """Conversations as files, a page per turn with up to two images: what their pages say of each file."""
    c = table(spark, d, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"])
    share = lambda i: ((F.col("conv_id") * 7 + i * 31) % 101).cast("double")
    images = lambda i: (F.col("conv_id") + i) % 3
    areas = lambda i: F.when(images(i) == 0, F.array().cast("array<double>")).when(images(i) == 1, F.array(share(i))).otherwise(F.array(share(i) / 2, share(i) / 2))
    files = c.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", F.transform("turns", lambda t, i: F.struct(T.lines(t).alias("lines"), areas(i).alias("areas"))).alias("pages"))
    m = pdf.metrics(files.select(F.col("conv_id").cast("string").alias("path"), written(F.col("pages"), (F.col("conv_id") % 3).cast("int")).alias("content")))
    votes, types = detection.document_votes(m).select("doc_id", "pages", "sampled"), detection.pdf_types(m).select("doc_id", "file_type", "mode", "confidence")
    return votes.join(types, "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
