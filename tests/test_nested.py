"""VARIANT walks, guarded items, dumps and reports on odd rows."""

import json

from pyspark.sql import functions as F

from folio.operators import contracts, nested
from folio.plans import chain
from folio.sources import files


def test_schema_faults(spark):
    def check(*schemas, depth=4):
        rows = [(f"n{i}", s if isinstance(s, str) or s is None else json.dumps(s)) for i, s in enumerate(schemas)]
        return sorted(tuple(r) for r in nested.schema_faults(spark.createDataFrame(rows, "name string, text string"), depth).collect())

    fine = {"$id": "base", "type": ["object", "null"], "required": [], "properties": {"a": {"items": True, "enum": [1, "x", None]}, "type": {"multipleOf": 0.5}}, "anyOf": [{}, True], "additionalProperties": {"minLength": 0}, "x-own": 5, "$defs": {"e": {"properties": {"f": {"$ref": "#"}}}}}
    assert check(fine, {"$ref": "base"}, {"items": {"$ref": "base#/$defs/e/properties/f"}}) == []
    bad = {"type": "str", "required": ["a", "a"], "properties": [1], "allOf": [], "items": 3, "maximum": "9", "multipleOf": 0, "maxItems": 1.5, "uniqueItems": 1, "title": 7, "$defs": {"a": 5}, "not": {"$ref": "#/nowhere"}}
    got = check(bad, None, "{", [1])
    assert {(p, r) for n, p, r in got if n == "n0"} == {*((f"/{k}", "keyword") for k in ("type", "required", "properties", "allOf", "items", "maximum", "multipleOf", "maxItems", "uniqueItems", "title")), ("/$defs/a", "not a schema"), ("/not/$ref", "unresolved")}
    assert [x for x in got if x[0] != "n0"] == [("n1", "", "not JSON"), ("n2", "", "not JSON"), ("n3", "", "not a schema")]


def test_geometry_in_both_forms(spark):
    summaries = [
        (1, '{"page_geometry": {"1": {"width": 10, "height": "x"}, "0": {"width": 1}, "a": {}}, "page_metrics": [{"page": 1, "width": "20.5"}, {"page": "2", "rotation": 90}, 7]}'), (2, '{"page_sizes": [{"page": 3, "width": 1}, {"page": 3, "width": 2, "height": null}]}'),
        (3, "{}"), (4, "no"), (5, None),
    ]
    got = {(r.doc_id, r.page): (r.width, r.height, r.rotation) for r in nested.geometry(spark.createDataFrame(summaries, "doc_id int, summary string")).collect()}
    assert got == {(1, 1): (20.5, 0.0, None), (1, 2): (None, None, 90.0), (2, 3): (2.0, None, None)}


def test_a_bad_file_stops_nothing(spark):
    rows = [("a.docx", 3, b"bad"), ("b.txt", 5, b"fine!"), ("c.zzz", 1, b"?"), (None, 1, b""), ("gone.txt", None, None)]
    df = spark.createDataFrame(rows, "path string, length long, content binary")
    found = {r.path: (r.file_type, r.confidence, r.mode, r.error) for r in chain.detected(df).collect()}
    assert found["gone.txt"] == ("unknown", 0.0, "mixed", "detect_failed: cannot be opened") and found[None][3] == "detect_failed: no path" and found["c.zzz"] == ("unknown", 0.3, "mixed", None)
    failed = {(r.path, r.stage) for r in chain.failed(chain.detected(df), files.read_faults(df)).collect()}
    assert failed == {(None, "detect"), ("gone.txt", "detect"), ("a.docx", "read")}


def test_dumps_of_words(spark):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    row = lambda line, conf, text: f"5\t1\t1\t1\t{line}\t1\t0\t0\t1\t1\t{conf}\t{text}"
    dumps = [(1, head + "\n".join([row(1, 90.5, "a"), row(1, -1, "b"), "", row(2, "x", "c"), row(2, "nan", ""), "5\t1", row(3, 80, "d")])), (2, head), (3, None)]
    got = {r.id: (r.text, r.avg_conf, r.words) for r in files.ocr_pages(spark.createDataFrame(dumps, "id int, tsv string")).collect()}
    assert got == {1: ("a b\nc\nd", 85.25, 4), 2: ("", None, 0), 3: ("", None, 0)}


def test_first_errors_and_gates_by_level(spark):
    rows = [("p", "g", i, "e|" if i % 2 else None) for i in range(20)] + [("p", "h", 50, None), ("q", "g", 3, "z"), (None, "g", 1, None)]
    got = {(r.level, r.phase, r.glob): (r.checks, r.fails, r.passed, r.errors) for r in contracts.report_levels(spark.createDataFrame(rows, "phase string, glob string, file long, error string"), 0.48).collect()}
    assert got["glob", "p", "g"] == (20, 10, False, [f"{i}: e|" for i in (1, 3, 5, 7, 9)]) and got["phase", "p", None] == (21, 10, True, got["glob", "p", "g"][3])
    assert got["all", None, None] == (23, 11, True, ["1: e|", "3: e|", "3: z", "5: e|", "7: e|"]) and got["glob", "p", "h"][3] == [] and got["phase", None, None][:2] == (1, 0)
    lines = contracts.markdown(contracts.report_levels(spark.createDataFrame(rows, "phase string, glob string, file long, error string"))).where("phase = 'q' and level = 'glob'").collect()
    assert lines[0].line == "| glob | q | g | 1 | 1 | 100.00% | FAIL | 3: z |"


def test_numbering_over_blocks(spark):
    m = spark.createDataFrame([(i, n) for i, n in enumerate((1, 2, 5, 4, 4, 9, 9, 10))], "position long, number long").repartition(3)
    for block in (1, 3, 100):
        assert sorted((r.position, r.number, r.before) for r in contracts.numbering_faults(m, block).collect()) == [(3, 4, 5), (4, 4, 4), (6, 9, 9)], block
    assert contracts.numbering_faults(m.where(F.lit(False))).count() == 0
