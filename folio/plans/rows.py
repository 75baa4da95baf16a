"""Functions whose odd cases tests hold, applied to every row of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import detect, geometry, values
from folio.operators import contracts, layout
from folio.plans import more
from folio.plans.registry import query
from folio.plans.views import table
from folio.sources import files


def _pick(by: str, *options):
    return F.get(F.array(*map(F.lit, options)), F.expr(by).cast("int"))


@query("""WITH e AS (SELECT event_id AS id, CASE user_id % 3 WHEN 0 THEN '' WHEN 2 THEN 'p' || event_id END AS p, CASE WHEN event_id % 2 = 0 THEN 'f' || event_id END AS f, CASE WHEN event_id % 5 = 0 THEN 's' ELSE '' END AS s FROM events),
x AS (SELECT id, CASE WHEN p <> '' THEN p WHEN f <> '' THEN f WHEN s <> '' THEN s END AS path FROM e) SELECT id, path, CASE WHEN path IS NULL THEN 'missing_path' END AS reason FROM x""")
def path_or_skipped(spark, d):
    e = table(spark, d, "events")
    p = F.when(F.col("user_id") % 3 == 0, "").when(F.col("user_id") % 3 == 2, F.concat(F.lit("p"), "event_id"))
    items = e.select(F.col("event_id").alias("id"), p.alias("path"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("f"), "event_id")).alias("file_path"), F.when(F.col("event_id") % 5 == 0, "s").otherwise("").alias("source_path"))
    named, skipped = files.paths(items)
    return named.select("id", "path", F.lit(None).cast("string").alias("reason")).unionByName(skipped.select("id", "path", "reason"))


@query("""WITH e AS (SELECT event_id AS id, [NULL, 'OCR', 'native'][1 + user_id % 3] AS o, ['Native', NULL, 'Mixed', NULL][1 + event_id % 4] AS d, [NULL, 'ocr'][1 + user_id % 2] AS f, ['pdf_text', 'docx', NULL, 'PDF_scanned'][1 + event_id // 4 % 4] AS kind,
  CASE WHEN event_id % 10 < 9 THEN event_id % 10 / 10 END AS c, ['light', 'full', 'off', NULL][1 + user_id // 3 % 4] AS tm, CASE WHEN user_id % 2 = 0 THEN 200 + event_id % 100 END AS dpi FROM events)
SELECT id, lower(CASE WHEN lower(kind) LIKE 'pdf%' AND coalesce(c, 0) < 0.7 THEN 'mixed' ELSE coalesce(o, d, f, 'mixed') END) AS mode, CASE tm WHEN 'light' THEN 'detect' WHEN 'full' THEN 'extract' ELSE tm END AS tables_mode, coalesce(dpi, 300)::BIGINT AS dpi FROM e""")
def parameters(spark, d):
    mode = detect.mode(_pick("user_id % 3", None, "OCR", "native"), _pick("event_id % 4", "Native", None, "Mixed", None), _pick("user_id % 2", None, "ocr"), _pick("event_id div 4 % 4", "pdf_text", "docx", None, "PDF_scanned"), F.when(F.col("event_id") % 10 < 9, F.col("event_id") % 10 / 10))
    dpi = detect.parameter(F.when(F.col("user_id") % 2 == 0, 200 + F.col("event_id") % 100), F.lit(None), F.lit(300))
    return table(spark, d, "events").select(F.col("event_id").alias("id"), mode.alias("mode"), detect.tables_mode(_pick("user_id div 3 % 4", "light", "full", "off", None)).alias("tables_mode"), dpi.cast("long").alias("dpi"))


@query("""WITH t AS (SELECT event_id AS id, ['ok', 'fallback', 'detect', 'failed', 'inadmissible', NULL][1 + event_id // 30 % 6] AS status, user_id % 4 AS rows, event_id % 5 AS cols, event_id * 7 % 901 AS cells, user_id // 4 % 3 AS h, event_id // 5 % 2 AS v, ['ocr', 'pdf', NULL][1 + event_id // 10 % 3] AS tool FROM events)
SELECT id, status, rows, cols, least(1, greatest(0, CASE lower(coalesce(status, 'failed')) WHEN 'ok' THEN 0.85 WHEN 'fallback' THEN 0.6 WHEN 'detect' THEN 0.6 WHEN 'inadmissible' THEN 0.1 ELSE 0.2 END + 0.25::DOUBLE * least(cells / 200.0::DOUBLE, 1) + CASE WHEN rows >= 2 AND cols >= 2 THEN 0.25 WHEN rows >= 1 AND cols >= 1 THEN 0.1 ELSE 0 END))::DOUBLE AS confidence,
  CASE WHEN h + v > 0 AND cols >= 3 AND rows >= 2 THEN 'rulings,columns,grid' WHEN h + v > 0 AND cols >= 3 THEN 'rulings,columns' WHEN h + v > 0 AND cols >= 2 AND rows >= 2 THEN 'rulings,grid' WHEN h + v > 0 THEN 'rulings'
  WHEN cols >= 3 AND rows >= 2 THEN 'columns,grid' WHEN cols >= 3 THEN 'columns' WHEN cols >= 2 AND rows >= 2 THEN 'grid' ELSE 'layout' END AS cues, CASE WHEN coalesce(tool, '') <> 'ocr' AND h + v > 0 THEN 'morph' ELSE 'text-alignment' END AS method FROM t""")
def table_candidates(spark, d):
    c = F.col
    given = _pick("event_id div 30 % 6", "ok", "fallback", "detect", "failed", "inadmissible", None).alias("status")
    t = table(spark, d, "events").select("*", given)
    t = t.selectExpr("event_id as id", "status", "user_id % 4 as rows", "event_id % 5 as cols", "event_id * 7 % 901 as cells", "user_id div 4 % 3 as h", "event_id div 5 % 2 as v", "get(array('ocr', 'pdf', null), cast(event_id div 10 % 3 as int)) as tool")
    confidence = layout.table_confidence(c("status"), c("rows"), c("cols"), c("cells")).cast("double").alias("confidence")
    return t.select("id", "status", "rows", "cols", confidence, F.array_join(layout.table_cues(c("rows"), c("cols"), c("h"), c("v")), ",").alias("cues"), layout.table_method(c("h"), c("v"), c("tool")).alias("method"))


@query("""WITH b AS (SELECT event_id AS id, (event_id * 3 % 220 - 10)::DOUBLE AS w, (user_id * 5 % 90)::DOUBLE AS h, (event_id * 13 % 800)::DOUBLE AS y FROM events), v AS (SELECT id, w, h, w * h / 505750 AS r, (y + y + h) / 2 / 850 AS cy FROM b)
SELECT id, CASE WHEN w <= 0 OR h <= 0 OR r < 5e-4 THEN NULL WHEN cy > 0.6 AND w / h >= 2.5 AND r < 0.1 THEN 'signature' WHEN w / h BETWEEN 0.5 AND 1.5 AND r BETWEEN 0.003 AND 0.1 THEN 'stamp' WHEN cy < 0.25 AND r <= 0.15 THEN 'logo' END AS kind FROM v""")
def visual_artifacts(spark, d):
    box = "array(20D, cast(event_id * 13 % 800 as double), cast(20 + event_id * 3 % 220 - 10 as double), cast(event_id * 13 % 800 + user_id * 5 % 90 as double)) as b"
    return table(spark, d, "events").selectExpr("event_id as id", box).select("id", geometry.visual_artifact(F.col("b"), F.lit(595.0), F.lit(850.0))["kind"].alias("kind"))


@query("""WITH g AS (SELECT conv_id, turn, unnest(range(turn % 4)) AS i, conv_id % 4 AS c FROM conversations), j AS (SELECT conv_id, turn, i, unnest(range(c)) AS j FROM g)
SELECT conv_id, turn, i::INT AS row, j::INT AS col, (j * 10) || ',' || (i * 20) || ',' || (j * 10 + 10) || ',' || (i * 20 + 20) AS bbox FROM j""")
def grid_cells(spark, d):
    lines = lambda n, step: F.transform(F.sequence(F.lit(0).cast("long"), n), lambda i: i * step)
    x = table(spark, d, "conversations").select("conv_id", "turn", F.explode(layout.grid_cells(lines(F.col("turn") % 4, 20), lines(F.col("conv_id") % 4, 10))).alias("x"))
    return x.select("conv_id", "turn", "x.row", "x.col", F.array_join("x.bbox", ",").alias("bbox"))


@query("SELECT count(*) AS breaks, count(*) = 0 AS ok FROM (SELECT unnest([page_id % 2 = 0 AND NOT (page_id % 3 = 0 AND page_id % 7 <> 0), page_id % 3 = 0 AND page_id % 7 <> 0 AND page_id % 2 <> 0, page_id % 7 = 0, page_id % 7 <> 0 AND page_id % 5 IN (1, 2)]) AS b FROM pages) WHERE b")
def contract_compatible(spark, d):
    return contracts.compatible(more.property_diff(spark, d), "1.4.2", "1.5.0")


@query("SELECT position, number, before FROM (SELECT *, lag(number) OVER (ORDER BY position) AS before FROM (SELECT event_id AS position, event_id - CASE WHEN user_id % 9 = 0 THEN event_id % 4 ELSE 0 END AS number FROM events)) WHERE number <= before")
def migration_order(spark, d):
    m = table(spark, d, "events").select(F.col("event_id").alias("position"), (F.col("event_id") - F.when(F.col("user_id") % 9 == 0, F.col("event_id") % 4).otherwise(0)).alias("number"))
    return contracts.numbering_faults(m, 500).select("position", "number", "before")


@query("""SELECT event_id, '{"a": ' || event_id || ', "at": "<ts>"' || CASE WHEN user_id % 3 = 0 THEN ', "schema_version": "1.' || user_id % 5 || '"' ELSE '' END || ', "meta": {"version": "m' || user_id % 4 || '"}}' AS masked,
  CASE WHEN user_id % 3 = 0 THEN '1.' || user_id % 5 ELSE 'm' || user_id % 4 END AS version FROM events""")
def golden_mask(spark, d):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    j = F.concat(
        F.lit('{"a": '), "event_id", F.lit(', "created_at": "'), iso, F.lit('", "at": "'), iso, F.lit('"'), F.when(F.col("user_id") % 3 == 0, F.concat(F.lit(', "schema_version": "1.'), F.col("user_id") % 5, F.lit('"'))).otherwise(""),
        F.lit(', "run_id": "x", "meta": {"version": "m'), F.col("user_id") % 4, F.lit('"}}'),
    )
    return table(spark, d, "events").select("event_id", values.without_volatile(j).alias("masked"), values.version_marker(j).alias("version"))
