"""Queries of nested documents, guards and reports, with SQL that tells the same from the rules by which the rows are made."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import contracts, nested
from folio.plans import chain
from folio.plans.registry import query
from folio.plans.views import table
from folio.sources import files


def _schemas(spark, d):
    """A schema per page, with faults by its number."""
    parts = """concat('{"$id": "s', page_id, '", "type": ', case page_id % 5 when 0 then '"strin"' when 1 then '["string", "string"]' else '"object"' end,
      ', "required": ', case page_id % 7 when 0 then '"a"' when 1 then '["a", 1]' else '["a"]' end, ', "properties": {"a": {"type": "string", "minLength": ', case page_id % 4 when 0 then '-1' when 1 then '1.5' else '3' end,
      '}, "items": {"anyOf": ', case page_id % 6 when 0 then '[]' when 1 then '[{"type": "null"}, 7]' else '[{"type": "null"}]' end, '}, "c": {"$ref": "', case page_id % 3 when 0 then '#/$defs/d' when 1 then '#/$defs/zz' else concat('s', page_id + 1, '#/$defs/d') end,
      '"}}, "$defs": {"d": {"type": "integer", "minimum": ', if(page_id % 8 = 0, '"x"', '0'), ', "items": ', if(page_id % 9 = 0, '5', 'true'), '}}', if(page_id % 13 = 0, '', '}'))"""
    return table(spark, d, "pages").selectExpr("concat('p', page_id) as name", f"{parts} as text")


@query("""WITH p AS (SELECT page_id AS i FROM pages), g AS (SELECT i FROM p WHERE i % 13 <> 0)
SELECT 'p' || i AS name, '' AS path, 'not JSON' AS reason FROM p WHERE i % 13 = 0
UNION ALL SELECT 'p' || i, '/type', 'keyword' FROM g WHERE i % 5 < 2 UNION ALL SELECT 'p' || i, '/required', 'keyword' FROM g WHERE i % 7 < 2
UNION ALL SELECT 'p' || i, '/properties/a/minLength', 'keyword' FROM g WHERE i % 4 < 2 UNION ALL SELECT 'p' || i, '/properties/items/anyOf', 'keyword' FROM g WHERE i % 6 = 0
UNION ALL SELECT 'p' || i, '/properties/items/anyOf/1', 'not a schema' FROM g WHERE i % 6 = 1
UNION ALL SELECT 'p' || i, '/$defs/d/minimum', 'keyword' FROM g WHERE i % 8 = 0 UNION ALL SELECT 'p' || i, '/$defs/d/items', 'keyword' FROM g WHERE i % 9 = 0
UNION ALL SELECT 'p' || i, '/properties/c/$ref', 'unresolved' FROM g WHERE i % 3 = 1 OR (i % 3 = 2 AND NOT EXISTS (SELECT 1 FROM g o WHERE o.i = g.i + 1))""")
def schema_faults(spark, d):
    return nested.schema_faults(_schemas(spark, d), 3)


@query("""WITH c AS (SELECT conv_id AS doc_id, turn AS t, length(text) AS n FROM conversations),
a AS (SELECT doc_id, t AS page, CASE WHEN t % 5 = 4 THEN 0 ELSE 500 + n END::DOUBLE AS width, CASE WHEN t % 2 = 0 THEN 800.5 END::DOUBLE AS height FROM c WHERE doc_id % 2 = 0 AND t > 0
  UNION ALL SELECT doc_id, t, CASE WHEN t % 5 = 4 THEN 0 ELSE 500 + n END::DOUBLE, CASE WHEN t % 2 = 0 THEN 800.5 END::DOUBLE FROM c WHERE doc_id % 2 = 1 AND t > 0),
b AS (SELECT doc_id, t AS page, CASE WHEN t % 3 = 1 THEN 700 END::DOUBLE AS width, (t * 90)::DOUBLE AS rotation FROM c WHERE t > 0)
SELECT doc_id, page::INT AS page, coalesce(b.width, a.width) AS width, a.height, b.rotation FROM a JOIN b USING (doc_id, page)""")
def summary_geometry(spark, d):
    """Summaries of conversations: entries by page for every second, lists of entries for the others; later places fill in more."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("t"), F.length("text").alias("n"))
    width = F.when(F.col("t") % 5 == 4, F.lit('"wide"')).otherwise((500 + F.col("n")).cast("string"))
    figures = F.concat(F.lit('"width": '), width, F.when(F.col("t") % 2 == 0, ', "height": "800.5"').otherwise(', "height": null'))
    by_page = F.concat(F.lit('"'), F.col("t"), F.lit('": {'), figures, F.lit("}"))
    entry = F.concat(F.lit('{"page": '), F.col("t"), F.lit(", "), figures, F.lit("}"))
    later = F.concat(F.lit('{"page": "'), F.col("t"), F.lit('", "rotation": '), F.col("t") * 90, F.when(F.col("t") % 3 == 1, ', "width": 700').otherwise(""), F.lit("}"))
    g = c.groupBy("doc_id").agg(*[F.array_join(F.collect_list(x), ", ").alias(n) for n, x in (("p", by_page), ("e", entry), ("l", later))])
    first = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('"page_geometry": {"x": {"width": 1}, "y": 5, '), "p", F.lit("}"))).otherwise(F.concat(F.lit('"page_dimensions": [5, {"width": 1}, '), "e", F.lit("]")))
    s = g.select("doc_id", F.concat(F.lit("{"), first, F.lit(', "page_sizes": "none", "page_metrics": ['), "l", F.lit("]}")).alias("summary"))
    return nested.geometry(s).select("doc_id", "page", "width", "height", "rotation")


@query("""WITH f AS (SELECT page_id AS i, CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 7 = 1 THEN '' ELSE 'in/' || page_id || ['.txt', '.docx', '.png', '.zzz', '.json'][1 + page_id % 5] END AS path, CASE WHEN page_id % 11 <> 0 THEN length(html) END AS n FROM pages),
e AS (SELECT *, CASE WHEN coalesce(path, '') = '' THEN 'no path' WHEN n IS NULL THEN 'cannot be opened' END AS fault FROM f)
SELECT path, CASE WHEN fault IS NULL THEN ['txt', 'docx', 'image', 'unknown', 'txt'][1 + i % 5] ELSE 'unknown' END AS file_type, CASE WHEN fault IS NOT NULL THEN 0 WHEN i % 5 = 3 THEN 0.3 ELSE 0.95 END::DOUBLE AS confidence,
  CASE WHEN fault IS NOT NULL OR i % 5 = 3 THEN 'mixed' WHEN i % 5 = 2 THEN 'ocr' ELSE 'native' END AS mode, CASE WHEN fault IS NULL AND i % 5 = 2 THEN 320 END::INT AS dpi, CASE WHEN fault IS NULL AND i % 5 = 2 THEN 6 END::INT AS psm, 'detect_failed: ' || fault AS error FROM e""")
def guarded_items(spark, d):
    pick = F.get(F.array(*map(F.lit, (".txt", ".docx", ".png", ".zzz", ".json"))), (F.col("page_id") % 5).cast("int"))
    path = F.when(F.col("page_id") % 7 == 0, None).when(F.col("page_id") % 7 == 1, "").otherwise(F.concat(F.lit("in/"), F.col("page_id"), pick))
    f = table(spark, d, "pages").select(path.alias("path"), F.when(F.col("page_id") % 11 != 0, F.length("html")).alias("length"))
    return chain.detected(f).select("path", "file_type", F.col("confidence").cast("double").alias("confidence"), "mode", "dpi", "psm", "error")


def _results(spark, d):
    e = table(spark, d, "events")
    error = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("bad | "), (F.col("event_id") % 3).cast("string")))
    return e.select(F.concat(F.lit("phase_0"), F.col("user_id") % 4).alias("phase"), F.col("event_type").alias("glob"), F.col("event_id").alias("file"), error.alias("error"))


_LEVELS = """r AS (SELECT 'phase_0' || (user_id % 4) AS phase, event_type AS "glob", event_id AS file, CASE WHEN user_id % 7 = 0 THEN 'bad | ' || (event_id % 3) END AS error FROM events),
v AS (SELECT CASE grouping(phase, "glob") WHEN 0 THEN 'glob' WHEN 1 THEN 'phase' ELSE 'all' END AS level, phase, "glob", count(*) AS checks, count(error) AS fails, count(error) / count(*) <= 0.145 AS passed,
  coalesce(array_to_string((list(file || ': ' || error ORDER BY file) FILTER (WHERE error IS NOT NULL))[1:5], '; '), '') AS errors FROM r GROUP BY ROLLUP (phase, "glob"))"""


@query(f"WITH {_LEVELS} SELECT * FROM v")
def report_levels(spark, d):
    return contracts.report_levels(_results(spark, d), 0.145).withColumn("errors", F.array_join("errors", "; "))


@query(f"""WITH {_LEVELS} SELECT level, phase, "glob", '| ' || level || ' | ' || coalesce(phase, '') || ' | ' || coalesce("glob", '') || ' | ' || checks || ' | ' || fails || ' | ' || printf('%.2f%%', 100.0 * fails / checks) || ' | ' ||
  CASE WHEN passed THEN 'pass' ELSE 'FAIL' END || ' | ' || replace(errors, '|', '\\|') || ' |' AS line FROM v""")
def report_markdown(spark, d):
    return contracts.markdown(contracts.report_levels(_results(spark, d), 0.145))


@query(r"""WITH w AS (SELECT conv_id, turn, unnest(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w, generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), 1) AS i FROM conversations),
c AS (SELECT *, (length(w) * 37 + i * 11 + turn) % 110 - 10 AS conf FROM w)
SELECT t.conv_id, t.turn, coalesce(string_agg(w, CASE WHEN i % 7 = 1 THEN chr(10) ELSE ' ' END ORDER BY i), '') AS text, round((sum(conf) FILTER (WHERE conf >= 0))::DOUBLE / count(*) FILTER (WHERE conf >= 0), 2) AS avg_conf, count(w) AS words
FROM (SELECT DISTINCT conv_id, turn FROM conversations) t LEFT JOIN c USING (conv_id, turn) GROUP BY t.conv_id, t.turn""".replace("string_agg(w, CASE WHEN i % 7 = 1 THEN chr(10) ELSE ' ' END ORDER BY i)", "ltrim(string_agg(CASE WHEN i % 7 = 1 THEN chr(10) ELSE ' ' END || w, '' ORDER BY i), chr(10))"))
def ocr_tsv(spark, d):
    """Dumps of all turns: a word per row, seven words a line, confidences from -10."""
    c = table(spark, d, "conversations").select("conv_id", "turn", F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "").alias("w"))
    conf = lambda x, i: (F.length(x) * 37 + (i + 1) * 11 + F.col("turn")) % 110 - 10
    row = lambda x, i: F.concat_ws("\t", F.lit("5\t1\t1\t1"), F.floor(i / 7).cast("string"), (i % 7 + 1).cast("string"), F.lit("0\t0\t9\t9"), conf(x, i).cast("string"), x)
    head = F.lit("level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext")
    tsv = F.concat_ws("\n", head, F.lit("1\t1\t0\t0\t0\t0\t0\t0\t600\t800\t-1\t"), F.array_join(F.transform("w", row), "\n"), F.lit("too\tshort"), F.lit(""))
    return files.ocr_pages(c.select("conv_id", "turn", tsv.alias("tsv"))).select("conv_id", "turn", "text", "avg_conf", "words")
