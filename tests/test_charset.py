"""Charset detection: held-out accuracy over documents in six encodings, marks, odd contents, strict decoding."""

from pyspark.sql import functions as F

from folio.operators import charset
from folio.plans import chain, registry

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = registry.queries()["charset_detect"](spark, DIR).toPandas()
    assert len(got) == 1000 and got.doc_id.is_unique
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()}
    held = got[got.held_out]
    # Texts that a wrong answer would decode alike (ASCII only) count as right.
    right = [r.encoding == r.written or texts[r.doc_id].encode(r.written, "replace").decode(r.encoding, "replace") == texts[r.doc_id].encode(r.written, "replace").decode(r.written) for r in held.itertuples()]
    assert len(held) > 100 and sum(right) / len(right) >= 0.97
    single = held[held.written.isin(charset.SINGLE) & held.encoding.isin(charset.SINGLE)]
    assert len(single) > 10 and single.confidence.between(0.3, 0.99).all()


def test_marks_states_and_odd_contents(spark):
    model = charset.fit(spark.createDataFrame([("schön größer über",), ("déjà vu où",), (None,), ("",), ("plain",)], "text string"))
    words = "größer über schön"
    for name in charset.SINGLE + ("utf-8", "utf-16-le", "utf-16-be", "utf-32-le", "utf-32-be"):
        assert charset.guess(words.encode(name), model)[0] == name, name
    for name in ("utf-8-sig", "utf-16", "utf-32"):
        found = charset.guess(words.encode(name), model)
        assert found[2] and found[1] == 1.0 and words.encode(name).decode(found[0]).removeprefix("﻿") == words
    assert charset.guess(b"", model)[0] == "utf-8" and charset.guess(b"a\x00b", model)[0] == "utf-8" and charset.guess(b"\xff\xfe\x00", model)[0] in charset.SINGLE
    short, long = charset.guess(b"\xf6", model)[1], charset.guess("schön größer".encode("cp1252"), model)[1]
    assert short < long <= charset.SURE
    nothing = charset.fit(spark.createDataFrame([], "text string"))
    assert charset.guess(b"\xe4", nothing)[1] == round(1 / 3, 3)


def test_strict_decoding(spark):
    df = spark.createDataFrame([(1, "ä".encode(), "utf-8"), (2, b"\xe4", "utf-8"), (3, None, "utf-8"), (4, b"x", "nope"), (5, b"\xef\xbb\xbfz", "utf-8")], "i int, content binary, e string")
    rows = {r.i: r for r in charset.decoded(df, "content", "e", strict=True).collect()}
    assert rows[1].text == "ä" and rows[2].text is None and rows[2].error.startswith("UnicodeDecodeError") and rows[3].text is None and rows[3].error is None and rows[4].error.startswith("LookupError") and rows[5].text == "z"
    assert {r.i: r.text for r in charset.decoded(df.where(F.col("i") == 2), "content", "e").collect()} == {2: "�"}


def test_the_chain_reads_normalised_text(spark, tmp_path):
    words = "größer über schön wäre\r\nfür alle"
    for i, name in enumerate(("utf-8", "utf-16", "cp850", "cp1252")):
        (tmp_path / f"f{i}.txt").write_bytes(words.encode(name))
    model = charset.fit(spark.createDataFrame([("schön größer über wäre für",)], "text string"))
    got = chain.run(spark, [str(tmp_path)], "20250101T120000-deadbeef", model=model)
    assert [r.text for r in got.pages.collect()] == [words.replace("\r\n", "\n")] * 4
    plain = chain.run(spark, [str(tmp_path)], "20250101T120000-deadbeef").pages.collect()
    assert sum(r.text == words.replace("\r\n", "\n") for r in plain) == 2  # UTF-8, and Latin-1 as the guess
