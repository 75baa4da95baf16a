"""Every registered query against its SQL in DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from folio.plans import registry
from tests import literal_queries

DIR = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


def compare(spark, duck, name, queries, sql):
    df = queries[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(sql[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(norm(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    compare(spark, duck, name, registry.queries(), registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(literal_queries.QUERIES))
def test_odd_literals(spark, duck, name):
    compare(spark, duck, name, literal_queries.QUERIES, literal_queries.ORACLE)


def test_plans_push_down_and_stay_in_the_jvm(spark):
    def plan(name):
        return registry.queries()[name](spark, DIR)._jdf.queryExecution().toString()

    for name in registry.queries():
        if name not in ("log_repeats", "log_rate_limit", "nfc_digest", "charset_detect", "pdf_pages", "pdf_file_types", "pixel_grids", "raster_steps", "handler_file", "handler_console"):
            found = plan(name)
            assert "Python" not in found and "Pandas" not in found and "CartesianProduct" not in found, name
    for name in ("language_share", "document_meta", "page_statistics", "document_summary", "document_language"):
        assert plan(name).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0].count("[^A-Za-z0-9]+") <= 2, name
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan("projection_peaks")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan("language_hint")


def test_table_candidates_hold_all_that_is_told_of_a_table(spark):
    """Of every event a table with its confidence, as the odd literals have it; not cues and method alone."""
    df = registry.queries()["table_candidates"](spark, DIR)
    rows = df.collect()
    assert df.columns == ["id", *literal_queries.QUERIES["table_candidates"](spark, DIR).columns]
    assert len(rows) == spark.read.parquet(f"{DIR}/events.parquet").count() and {r.status for r in rows} == {"ok", "fallback", "detect", "failed", "inadmissible", None}
    base = {"ok": 0.85, "fallback": 0.6, "detect": 0.6, "inadmissible": 0.1}
    for r in rows:
        shape = 0.25 if min(r.rows, r.cols) >= 2 else 0.1 if min(r.rows, r.cols) >= 1 else 0
        assert math.isclose(r.confidence, min(1, base.get(r.status, 0.2) + min(r.id * 7 % 901 / 200, 1) / 4 + shape), abs_tol=1e-12)
