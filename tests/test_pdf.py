"""PDF files of odd make: what is read of them, and what is reported."""

import zlib

from folio.plans import chain, pdfs
from folio.sources import files, pdf


def file(*objects: bytes, trailer: bytes = b"/Root 1 0 R") -> bytes:
    return b"%PDF-1.4\n" + b"\n".join(b"%d 0 obj %s endobj" % (i + 1, o) for i, o in enumerate(objects)) + b"\ntrailer << " + trailer + b" >>"


def stream(data: bytes, keys: bytes = b"") -> bytes:
    return b"<< %s /Length %d >> stream\r\n%s\nendstream" % (keys, len(data), data)


ROOT, TREE = b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /MediaBox [0 0 100 100] /Resources << /Font << /F 5 0 R >> /XObject << /I 6 0 R >> >> >>"
PAGE, IMAGE = b"<< /Type /Page /Contents 4 0 R >>", stream(b"x", b"/Subtype /Image")


def read(spark, *contents):
    x = spark.createDataFrame([(f"{i}.pdf", c) for i, c in enumerate(contents)], "path string, content binary")
    got: dict = {}
    for r in pdf.read_pages(x).orderBy("path", "page").collect():
        got.setdefault(int(r.path[:-4]), []).append((r.text, r.blocks, r.images, round(r.image_area, 3), r.error))
    return got


def test_operators_in_order(spark):
    shown = b"""BT /F 9 Tf 14 TL 1 0 0 1 10 90 Tm (one) Tj 30 0 Td (two) Tj T* [(thr) 20 (ee) -500 (four)] TJ (five) ' ET
    q 40 0 0 50 0 0 cm /I Do Q /I Do BI /W 1 ID \x00 (EI not EI yet\x01 EI BT 0 0 Td (s\\(i\\)x \\101\\
\\n) Tj ET BT ET Tj % (none
    BT 0 0 Td <736576656> Tj ET"""
    font = b"<< /Type /Font /Encoding << /Differences [101 /adieresis /f 120 /uni20AC] >> >>"
    got = read(spark, file(ROOT, TREE, PAGE, stream(shown), font, IMAGE))
    # e is shown as a-umlaut and x as the sign of the euro; the second Td starts anew at the origin.
    assert got[0] == [("onä two\nthrää four\nfivä\ns(i)€ A\n sävä`".replace("\n säv", "\nsäv"), 3, 1, 0.2, None)]


def test_faults_are_rows(spark):
    bad_page = file(ROOT, TREE.replace(b"[3 0 R]", b"[3 0 R 7 0 R 2 0 R]"), PAGE, stream(b"\x00\x01", b"/Filter /FlateDecode"), b"<< >>", IMAGE, b"<< /Type /Page >>")
    got = read(spark, bad_page, file(ROOT, TREE, PAGE, trailer=b"/Root 1 0 R /Encrypt 9 0 R"), b"%PDF", b"", None, file(ROOT, TREE, PAGE, stream(b"BT (x) Tj ET", b"/Filter /JBIG2Decode")))
    assert got[0][0][4].startswith("error:") and got[0][1] == ("", 0, 1, 0.0, None) and len(got[0]) == 2
    assert [got[i][0][4] for i in (1, 2, 3, 4, 5)] == ["ValueError: encrypted", *["ValueError: no pages"] * 3, "ValueError: filter JBIG2Decode"]
    x = spark.createDataFrame([("a.pdf", bad_page), ("b.pdf", b"")], "path string, content binary")
    assert sorted(r.path for r in files.read_faults(x).collect()) == ["a.pdf", "b.pdf"] and pdf.pages(x).count() == 3
    assert pdf.pages(x.where("false")).count() == 0 and pdf.metrics(x.where("false")).count() == 0


def test_last_objects_count_and_streams_hide_theirs(spark):
    old = file(ROOT, TREE, PAGE, stream(b"BT (4 0 obj endobj) Tj ET"), b"<< >>", IMAGE)
    new = old + b"\n4 0 obj " + stream(zlib.compress(b"BT (new) Tj ET")[:-4], b"/Filter [/Fl]").replace(b"/Length", b"/Length 9 0 R /Was") + b" endobj"
    assert {i: g[0][0] for i, g in read(spark, old, new, old.replace(b"trailer", b"")).items()} == {0: "4 0 obj endobj", 1: "new", 2: "4 0 obj endobj"}


def test_ranges_of_codes():
    codes, lengths = pdf.character_map(b"1 begincodespacerange <00> <FF> endcodespacerange 2 beginbfrange <01> <03> <0041> <0004> <0005> [<00660069> <D83DDE00>] endbfrange")
    assert codes == {b"\x01": "A", b"\x02": "B", b"\x03": "C", b"\x00\x04": "fi", b"\x00\x05": "\U0001f600"} and lengths == [1, 2]


def test_a_file_of_many_pages_and_wide_text(spark):
    pages = [{"lines": [f"page {i} 中\U0001f600", "א"], "areas": []} for i in range(2500)]
    got = read(spark, pdfs.document(pages, 2), pdfs.document([], 1))
    assert [t[0] for t in got[0]] == ["\n".join(p["lines"]) for p in pages] and 1 not in got


def test_types_of_files(spark):
    full = {"lines": ["word " * 20] * 12, "areas": []}
    rows = [("a.pdf", pdfs.document([full, full], 0)), ("b.pdf", pdfs.document([full, {"lines": [], "areas": [50]}], 1)), ("c.pdf", b"?"), ("d.txt", b"")]
    x = spark.createDataFrame(rows, "path string, content binary").selectExpr("*", "cast(length(content) as long) as length")
    got = {r.path: (r.file_type, r.mode, r.dpi, r.ocr_recommended, r.confidence) for r in chain.typed_pdfs(chain.detected(x), pdf.metrics(x.where("path <> 'd.txt'"))).collect()}
    assert got == {"a.pdf": ("pdf_text", "native", 200, False, 0.9), "b.pdf": ("pdf_mixed", "mixed", 300, True, 1.0), "c.pdf": ("pdf_text", "native", 200, False, 0.0), "d.txt": ("txt", "native", None, False, 0.95)}
