"""Expected values of single functions, sources, sinks, streaming and the chain."""

import io
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folio.constants import PROFILES
from folio.functions import encoding, geometry
from folio.functions import text as T
from folio.operators import contracts, logs, metrics, readers
from folio.plans import chain, config, pdfs
from folio.sources import files, sinks
from folio.streaming import filters


def one(spark, column, **values):
    kinds = {str: "string", int: "long", float: "double", bool: "boolean", bytes: "binary", list: "array<double>"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_hints(spark):
    hint = lambda t: one(spark, T.language_hint(F.col("t")), t=t)
    assert hint("Das Krankenhaus hospital betreut Patienten and patients") == "mixed"
    assert hint("") == "unknown" and hint("xyz") == "unknown" and hint("the and for") == "en" and hint("der die und März maerz") == "de"
    locale = lambda t: one(spark, T.locale_hint(F.col("t")), t=t)
    assert locale("Rechnung vom 12.03.2024 ueber 1.200,00 EUR") in ("de", "mixed") and locale("nur 1.200,00 EUR") == "de" and locale("on 3/4/2024 for 1,200.00") == "en" and locale("12.03.2024 or 3/4/2024") == "mixed" and locale("none") == "unknown"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from(["de", "en", "unknown", "mixed"]), min_size=1, max_size=6))
def test_merging_does_not_depend_on_order(spark, hints):
    def fold(hs):
        out = "unknown"
        for h in hs:
            out = h if out == "unknown" else out if h in ("unknown", out) else "mixed"
        return out

    df = spark.createDataFrame([(h,) for h in hints], "h string")
    assert df.agg(T.merged_hint(F.col("h")).alias("m")).first().m == fold(hints) == fold(hints[::-1])


def test_lines_and_markers(spark):
    assert one(spark, T.block_text(F.col("t")), t="  a \r\n\n b c  ") == "a\nb\nc"
    assert one(spark, T.heading_like(F.col("t"), F.lit(1)), t="BIG NEWS TODAY") and not one(spark, T.heading_like(F.col("t"), F.lit(1)), t="an ordinary line of text that goes on and on")
    assert one(spark, T.heading_like(F.col("t"), F.lit(3), F.lit(18.0), F.lit(10.0)), t="quiet but large")
    assert one(spark, T.list_like(F.col("t")), t="1. abc") and not one(spark, T.list_like(F.col("t"), compat=True), t="1. abc")
    assert one(spark, T.numbering_marker(F.col("t")), t="12. x") == "" and one(spark, T.numbering_marker(F.col("t")), t=" 1) x") == "1)"
    assert one(spark, T.summary_line(F.lit("ocr"), F.lit("ok"), F.lit(3), F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1")))) == "ocr ok [p=3] a=1, b=2"


def test_redaction(spark):
    assert one(spark, T.redact(F.col("t")), t="Bearer abc.def mail x@y.zz tel +49 30 123456 ok") == "[REDACTED] mail [REDACTED] tel [REDACTED] ok"
    assert one(spark, T.redact_value("password", F.col("t")), t="x") == "[REDACTED]" and one(spark, T.redact_value("run_id", F.col("t")), t="a@b.cc") == "a@b.cc"
    assert one(spark, T.redact_value("user_id", F.col("t"), "s"), t=5) == one(spark, F.sha2(F.lit("s5"), 256))
    cut, was = T.truncated(F.col("t"))
    assert len(one(spark, cut, t="x" * 5000)) == 4096 and one(spark, was, t="x" * 5000) and not one(spark, was, t="x")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=4, max_size=4), st.integers(500, 900))
def test_flipping_twice_is_nothing(spark, box, height):
    b = [float(x) for x in box]
    assert one(spark, geometry.flip(geometry.flip(F.col("b"), F.lit(float(height))), F.lit(float(height))), b=b) == b


def test_boxes(spark):
    touch = geometry.intersect(F.array(*map(F.lit, (0.0, 0.0, 1.0, 1.0))), F.array(*map(F.lit, (1.0, 0.0, 2.0, 1.0))))
    assert not one(spark, touch) and one(spark, geometry.rotation(F.lit(-100.0))) == 270
    assert one(spark, geometry.four(F.array(F.lit("1"), F.lit("x"), F.lit("2.5")))) == [1.0, 2.5, 0.0, 0.0]


def test_encoding(spark):
    e = lambda c: one(spark, encoding.detect(F.col("c")), c=c)
    assert (e("Grüße".encode()).encoding, e("Grüße".encode("latin-1")).encoding, e(b"\xef\xbb\xbfx").bom, e(b"").encoding) == ("utf-8", "iso-8859-1", True, "utf-8")
    text = lambda c: one(spark, encoding.decode(F.col("c"), encoding.detect(F.col("c"))["encoding"]), c=c)
    assert text("Grüße".encode("latin-1")) == "Grüße" and text(b"\xef\xbb\xbfa\r\nb\rc") == "a\nb\nc"
    name = lambda p: one(spark, encoding.normalized_path(F.col("p")), p=p)
    assert (name("a/b.txt"), name("a/b")) == ("a/b.utf8.txt", "a/b.utf8.txt")


def test_encoding_of_whole_files(spark):
    from folio.plans import chain
    from folio.sources import files

    cut, bad = ("x" * 65_535 + "é").encode(), b"x" * 70_000 + b"\xe9"
    df = spark.createDataFrame([("a.txt", cut), ("b.txt", bad)], "path string, content binary")
    assert {r.path: r.encoding for r in chain.encoded(df).collect()} == {"a.txt": "utf-8", "b.txt": "iso-8859-1"}
    assert {r.path: r.text for r in files.text_pages(df).collect()} == {"a.txt": cut.decode(), "b.txt": bad.decode("latin-1")}


def test_thinning_of_logs(spark):
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate((0.0, 0.0, 0.0, 2.1, 3.2))], "i int, t double, k string")
    ids = lambda x: sorted(r.i for r in x.collect())
    assert ids(logs.limit_rate(df, 2, 2, ["k"], F.col("t"), ["t", "i"])) == [0, 1, 3, 4]
    assert ids(logs.drop_repeats(df, 1, ["k"], F.col("t"), ["t", "i"])) == [0, 3, 4]
    assert len(ids(logs.every_nth(spark.range(10).select(F.col("id").cast("int").alias("i")), 3, ["i"]))) == 3


def test_quantiles(spark):
    h = spark.createDataFrame([(1.0, 0), (2.0, 50), (5.0, 100), (float("inf"), 100)], "le double, n long").withColumn("k", F.lit("a"))
    q = lambda x, p: metrics.quantile(x, p, ["k"]).first()["quantile"]
    assert q(h, 0.75) == 3.5 and q(h, 0.5) == 2.0
    assert q(h.where("le > 100").union(spark.createDataFrame([(5.0, 10, "a")], h.schema)), 0.99) == 5.0


def test_contracts(spark):
    schema = {"required": ["run_id", "items"], "properties": {"run_id": {"type": "string", "format": "run-id"}, "items": {"type": "array", "minItems": 1, "items": {"$ref": "item"}}}}
    item = {"item": {"type": "object", "anyOf": [{"required": ["path"]}, {"required": ["file_path"]}]}}
    rows = [("20250101T120000-deadbeef", [("a", None)]), ("RID-1", [("a", None)]), (None, []), ("20250101T120000-deadbeef", [(None, None)])]
    df = spark.createDataFrame(rows, "run_id string, items array<struct<path:string,file_path:string>>")
    got = [sorted(v.validator for v in r.violations) for r in contracts.validate(df, schema, item).collect()]
    assert got == [[], ["format"], ["minItems", "required"], ["anyOf"]]
    errors, warnings = contracts.demote(F.col("violations"), ("format",))
    r = contracts.validate(df, schema, item).select(errors.alias("e"), warnings.alias("w"), contracts.outcome(F.col("violations"), dry_run=True).alias("d")).collect()[1]
    assert (r.e, len(r.w), r.d) == ([], 1, "VL-W001")
    assert one(spark, contracts.version_check(F.lit(None).cast("string"), F.lit("1"))) == "missing"


def docx(paragraphs, rows):
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    table = "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{p(c)}</w:tc>" for c in r) + "</w:tr>" for r in rows) + "</w:tbl>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body>{''.join(map(p, paragraphs))}{table}</w:body></w:document>")
    return out.getvalue()


def test_chain_over_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_bytes("The date and the page.\r\nGrüße".encode("latin-1"))
    (src / "b.docx").write_bytes(docx(["Hello ", " "], [["x", " y "], ["", ""]]))
    (src / "c.pdf").write_bytes(b"%PDF")
    (src / "e.pdf").write_bytes(pdfs.document([{"lines": ["The page"], "areas": []}, {"lines": [], "areas": [90]}], 1))
    (src / "f.pdf").write_bytes(pdfs.document([{"lines": [], "areas": [100]}], 2))
    (src / "d.docx").write_bytes(b"broken")
    got = chain.run(spark, [str(src)], "20250101T120000-deadbeef")
    name = lambda p: p.rsplit("/", 1)[1]
    assert {name(r.path): r.file_type for r in got.detected.collect()} == {"a.txt": "txt", "b.docx": "docx", "c.pdf": "pdf_text", "d.docx": "docx", "e.pdf": "pdf_scanned", "f.pdf": "pdf_scanned"}
    assert {(name(r.doc_id), r.page): (r.text, r.conf) for r in got.pages.collect()} == {
        ("a.txt", 1): ("The date and the page.\nGrüße", 92.0), ("b.docx", 1): ("Hello\nx | y", 90.0), ("c.pdf", 1): ("", 0.0), ("d.docx", 1): ("", 0.0),
        ("e.pdf", 1): ("The page", 80.0), ("e.pdf", 2): ("", 0.0), ("f.pdf", 1): ("", 0.0),
    }
    assert {(name(r.path), r.reason) for r in got.unread.collect()} == {("e.pdf", "no_reader:ocr"), ("f.pdf", "no_reader:ocr")}
    assert {(name(r.path), r.stage) for r in got.failed.collect()} == {("c.pdf", "read"), ("d.docx", "read")}
    assert {name(r.path): (r.mode, r.dpi, r.confidence) for r in got.items.collect() if r.path.endswith("pdf")} == {"c.pdf": ("native", 200, 0.0), "e.pdf": ("ocr", 320, 0.9), "f.pdf": ("ocr", 320, 0.9)}
    assert {name(r.path): r.encoding for r in got.encoded.collect()}["a.txt"] == "iso-8859-1"
    assert {name(r.doc_id): r.needs_review for r in got.summaries.collect()} == {"a.txt": False, "b.docx": False, "c.pdf": True, "d.docx": True, "e.pdf": True, "f.pdf": True}
    with pytest.raises(ValueError):
        files.binary(spark, [])


def test_sinks(spark, tmp_path):
    pages = readers.text_pages(spark.createDataFrame([(1, "The page"), (2, "")], "doc_id long, text string"))
    sinks.json_lines(pages.withColumn("ocr", F.when(F.col("doc_id") == 1, 5.0)), str(tmp_path / "j"))
    assert files.json_lines(spark, str(tmp_path / "j"), "doc_id long, text string, ocr double").count() == 2
    assert '"ocr"' not in [r.value for r in spark.read.text(str(tmp_path / "j")).collect() if '"doc_id":2' in r.value][0]
    sinks.page_csv(readers.page_stats(pages), str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == 2
    sinks.page_text(pages, str(tmp_path / "t"))
    assert "# file=1 page=1 source=native conf=92.00" in [r.value for r in spark.read.text(str(tmp_path / "t")).collect()]
    assert sinks.stage_dir("out/", "readers", "s1") == "out/s1/readers"
    with pytest.raises(ValueError):
        sinks.stage_dir("out", "merge")
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert sorted(r.a for r in files.json_lines(spark, str(tmp_path / "bad.jsonl"), "a int").collect() if r.a is not None) == [1, 2]


def test_streaming_equals_batch(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = tmp_path / "e"
    e.orderBy("ts").repartitionByRange(3, "ts").write.parquet(str(src))

    def drain(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name)

    stream = filters.parquet_stream(spark, str(src), e.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    got = {(r.start, r.event_type): r.rate for r in drain(filters.windowed_rate(stream, "1 day", 86400, "2 days", ["event_type"]), "rates", "append").collect()}
    want = {(r.start, r.event_type): r.rate for r in metrics.event_rate(e.withColumn("ts", F.col("ts").cast("timestamp")), "1 day", 86400, ["event_type"]).collect()}
    assert got and all(want[k] == v for k, v in got.items())
    batch = e.withColumn("ts", F.col("ts").cast("timestamp"))
    seconds = F.unix_micros("ts") / 1e6
    ids = lambda df: sorted(r.event_id for r in df.collect())
    assert ids(drain(filters.drop_repeats(stream, 7200, ["event_type"]), "repeats")) == ids(logs.drop_repeats(batch, 7200, ["event_type"], seconds, ["ts"]))
    assert ids(drain(filters.limit_rate(stream, 7200, 2, ["event_type"]), "limited")) == ids(logs.limit_rate(batch, 7200, 2, ["event_type"], seconds, ["ts"]))
    assert len(ids(drain(filters.every_nth(stream, 10, ["event_type"]), "tenth"))) == sum(n // 10 for (n,) in e.groupBy("event_type").count().select("count").collect())
    assert drain(filters.sessions(stream, "1 hour", "2 days", ["event_type"]), "sessions").count() > 0


def test_profiles():
    assert (PROFILES["prod"].low_conf, PROFILES["dev"].low_text_words, PROFILES["staging"].table_min_conf) == (70.0, 8, 0.55)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert len(e.queries()) >= 80 and set(e.oracle_sql()) <= set(e.queries())


def test_config(spark, monkeypatch):
    assert config.overlaid({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 5}, "e": 6}) == {"a": {"b": 5, "c": 2}, "d": 3, "e": 6}
    assert config.faults({"a": {"b": 7}, "t": True}, ("a.b", "z"), {"a.b": (0, 7)}, {"t": int, "a": str}) == ["z is missing", "a is not str"]
    monkeypatch.setenv("READERS_PROFILE", "dev")
    assert config.profile().low_conf == 60.0 and config.profile("prod").low_conf == 70.0
    flows = config.Flows()
    flows.register("n", lambda spark, n: spark.range(n))
    assert flows.has("n") and flows.run("n", spark, 3).count() == 3
    with pytest.raises(KeyError):
        flows.run("m", spark)

    @config.checked({"properties": {"id": {"type": "integer", "minimum": 0}}}, {"required": ["x"]})
    def add(df, by):
        return df.select((F.col("id") + by).alias("x"))

    assert add(spark.range(3), 1).count() == 3
    with pytest.raises(config.ContractError, match="VL-E001"):
        add(spark.range(-1, 2), 1)
    with pytest.raises(config.ContractError, match="VL-E002"):
        config.checked(None, {"required": ["y"]})(lambda df: df)(spark.range(1))


def test_greedy_filters_over_buckets(spark):
    """Against one pass over each key, with times that tie, gaps of every size and buckets smaller and larger than them; records without a time stay rows."""
    import random

    r = random.Random(6)
    rows, t = [], 0.0
    for i in range(600):
        t += r.choice((0.0, 0.5, 1.0, 2.0, 2.5, 9.0))
        rows.append((i, r.choice("ab"), t))
    df = spark.createDataFrame(rows, "i int, k string, t double")
    repeats, limited, last, window = [], [], {}, {}
    for i, k, t in rows:
        if k not in last or t - last[k] >= 2:
            repeats.append(i)
            last[k] = t
        start, n = window[k] if k in window and t - window[k][0] <= 2 else (t, 0)
        window[k] = (start, n + 1)
        limited += [i] * (n < 2)
    for span in (1.0, 7.0, 10_000.0):
        whole = lambda name, *a: sorted(x.i for x in name(df, *a, ["k"], F.col("t"), ["t", "i"], span=span).collect())  # noqa: E731, B023
        assert whole(logs.drop_repeats, 2) == repeats and whole(logs.limit_rate, 2, 2) == limited, span
    assert logs.drop_repeats(spark.createDataFrame([(1, "a", None)], df.schema), 2, ["k"], F.col("t"), ["t", "i"]).count() == 1
