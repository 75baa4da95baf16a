"""More queries of the engine, over whole tables: records of reading runs, routing of files, schemas, log selections, sliding windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio import constants as K
from folio.functions import detect, values
from folio.functions import text as T
from folio.operators import contracts, detection, layout, logs, metrics, readers, records
from folio.plans import chain, rules
from folio.plans.registry import _SAMPLE, LINES, _hint, _lines, _locale, _metrics, _pages, _tokens, _words, query
from folio.plans.views import LOGS, log_records, table

# ---- records of reading runs

_TABLES = """tb AS (SELECT conv_id AS doc_id, turn + 1 AS page, turn % 4 AS rows, CASE WHEN (conv_id + turn) % 3 = 0 THEN text ELSE '' END AS ocr, (conv_id + turn) % 2 = 0 AS det FROM conversations),
ts AS (SELECT *, CASE WHEN rows > 0 THEN CASE WHEN det THEN 'detect' ELSE 'ok' END WHEN ocr <> '' THEN 'fallback' ELSE 'failed' END AS status FROM tb)"""


def _tables(spark, d):
    c = table(spark, d, "conversations")
    ocr = F.when((F.col("conv_id") + F.col("turn")) % 3 == 0, F.col("text")).otherwise("")
    return c.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).alias("page"), records.table_status(F.col("turn") % 4, ocr, (F.col("conv_id") + F.col("turn")) % 2 == 0).alias("status"))


@query(f"WITH {_TABLES} SELECT doc_id, page, status FROM ts")
def table_status(spark, d):
    return _tables(spark, d)


@query(f"WITH {_TABLES} SELECT doc_id, count(*) FILTER (WHERE status IN ('ok', 'detect')) AS tables, array_to_string(list_sort(list_distinct(list(page))), ',') AS pages FROM ts GROUP BY doc_id")
def table_counts(spark, d):
    return records.table_counts(_tables(spark, d)).withColumn("pages", F.array_join("pages", ","))


@query(f"""WITH c AS (SELECT conv_id, turn, role = 'assistant' AS there, CASE WHEN turn % 3 <> 0 THEN text ELSE '' END AS o, text FROM conversations)
SELECT conv_id, turn, CASE WHEN there THEN o ELSE text END AS text, CASE WHEN there THEN (conv_id % 40 + 50)::DOUBLE ELSE 0 END::DOUBLE AS conf, (CASE WHEN there AND o = '' THEN turn * 2 WHEN there THEN {_words('o')} ELSE {_words('text')} END)::INT AS words, CASE WHEN there THEN turn * 1.5 ELSE 0 END::DOUBLE AS time_ms FROM c""")
def ocr_results(spark, d):
    c = table(spark, d, "conversations")
    payload = F.struct(F.when(F.col("turn") % 3 != 0, F.col("text")).alias("text"), (F.col("conv_id") % 40 + 50).alias("avg_conf"), (F.col("turn") * 2).alias("tokens"), (F.col("turn") * 1.5).alias("time_ms"))
    return c.select("conv_id", "turn", records.ocr_result(F.col("text"), F.when(F.col("role") == "assistant", payload)).alias("r")).select("conv_id", "turn", "r.*")


@query(f"""WITH p AS (SELECT conv_id AS doc_id, (turn + 1)::INT AS page, text, role = 'assistant' AS ocr, 40.0 + turn AS conf, (conv_id + turn) % 4 = 0 AS bare FROM conversations),
b AS (SELECT doc_id, page, unnest({_lines('text')}) AS text, unnest(range(len({_lines('text')})))::INT AS block, ocr, conf FROM p WHERE NOT bare
  UNION ALL SELECT doc_id, page, text, 0, ocr, conf FROM p WHERE bare OR len({_lines('text')}) = 0)
SELECT doc_id, page, page || '-' || block AS id, text, {_hint(_tokens('text'))} AS lang_hint, {_locale('text')} AS locale_hint, CASE WHEN ocr THEN conf END::DOUBLE AS ocr_conf_avg,
row_number() OVER (PARTITION BY doc_id ORDER BY page, block) - 1 AS reading_order_index FROM b""")
def page_blocks(spark, d):
    c = table(spark, d, "conversations")
    p = c.select(
        F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page"), "text", F.when(F.col("role") == "assistant", "native+OCR").otherwise("native").alias("decision"), (F.col("turn") + 40.0).cast("double").alias("ocr_conf"),
        ((F.col("conv_id") + F.col("turn")) % 4 == 0).alias("bare"),
    )
    b = p.where("not bare").select("doc_id", "page", F.posexplode(T.lines(F.col("text"))).alias("block", "text"))
    return records.page_blocks(p, b).select("doc_id", "page", "id", "text", "lang_hint", "locale_hint", "ocr_conf_avg", "reading_order_index")


@query("SELECT doc_id, string_agg(code, ',' ORDER BY first_at, code) AS warnings FROM (SELECT conv_id AS doc_id, 'W' || ((turn * 7 + conv_id) % 5) AS code, min(turn) AS first_at FROM conversations GROUP BY ALL) GROUP BY doc_id")
def warnings(spark, d):
    c = table(spark, d, "conversations")
    e = c.select(F.col("conv_id").alias("doc_id"), "turn", F.concat(F.lit("W"), ((F.col("turn") * 7 + F.col("conv_id")) % 5).cast("string")).alias("code"))
    return records.warnings(e, "turn").withColumn("warnings", F.array_join("warnings", ","))


@query("SELECT event_id, event_type || ' done' || CASE WHEN user_id % 2 = 0 THEN ' [p=' || (user_id % 9) || ']' ELSE '' END || ' user=' || user_id AS line FROM events")
def tool_events(spark, d):
    details = F.create_map(F.lit("text"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"), F.lit("content"), F.lit("x"))
    page = F.when(F.col("user_id") % 2 == 0, F.col("user_id") % 9)
    return table(spark, d, "events").select("event_id", T.summary_line(F.col("event_type"), F.lit("done"), page, records.tool_event(details)).alias("line"))


@query("""WITH p AS (SELECT conv_id AS doc_id, turn + 1 AS page, (conv_id * 3 + turn * 5) % 4 = 0 AS low, (conv_id + turn) % 6 = 0 AS flag FROM conversations)
SELECT doc_id, coalesce(array_to_string(list_sort(list(page) FILTER (WHERE low OR flag)), ','), '') AS pages FROM p GROUP BY doc_id""")
def flagged_pages(spark, d):
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page"), ((F.col("conv_id") * 3 + F.col("turn") * 5) % 4 == 0).alias("low"), ((F.col("conv_id") + F.col("turn")) % 6 == 0).alias("flag"))
    g = c.groupBy("doc_id").agg(*[F.collect_set(F.when(F.col(x), F.col("page"))).alias(x) for x in ("low", "flag")])
    return g.select("doc_id", F.array_join(records.flagged_pages(F.col("low"), F.col("flag")), ",").alias("pages"))


@query("SELECT conv_id AS doc_id, turn // 3 AS page, bool_or((conv_id * 3 + turn) % 7 IN (0, 4)) AS found FROM conversations GROUP BY ALL")
def zones_with_header(spark, d):
    kinds = F.array(*map(F.lit, ("Header", "text", "table", "image", "FOOTER", "text", "list")))
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.expr("cast(turn div 3 as int)").alias("page"), F.get(kinds, ((F.col("conv_id") * 3 + F.col("turn")) % 7).cast("int")).alias("zone"))
    return c.groupBy("doc_id", "page").agg(records.has_header_footer(F.collect_set("zone")).alias("found"))


@query("""WITH s AS (SELECT conv_id AS doc_id, CASE WHEN conv_id % 5 = 0 THEN 0 ELSE count(*) + conv_id % 2 END AS n, list(CASE role WHEN 'assistant' THEN 'native+ocr' WHEN 'user' THEN 'native' ELSE 'ocr' END ORDER BY turn) AS ds FROM conversations GROUP BY conv_id),
p AS (SELECT *, unnest(range(1, CASE WHEN n = 0 THEN len(ds) ELSE n END + 1)) AS page FROM s)
SELECT doc_id, page::INT AS page, coalesce(ds[page], 'text') AS decision, CASE coalesce(ds[page], 'text') WHEN 'native+ocr' THEN 'mixed' WHEN 'ocr' THEN 'ocr' ELSE 'text' END AS source, 'en' AS lang, 0 AS chars, 0::DOUBLE AS ocr_conf, 1 AS columns_count, false AS has_table FROM p""")
def fallback_page_stats(spark, d):
    c = table(spark, d, "conversations")
    decision = F.when(F.col("role") == "assistant", "native+ocr").when(F.col("role") == "user", "native").otherwise("ocr")
    s = c.groupBy(F.col("conv_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("turn", decision.alias("x")))), lambda v: v["x"]).alias("decisions"))
    s = s.select("doc_id", "decisions", F.when(F.col("doc_id") % 5 == 0, 0).otherwise(F.col("n") + F.col("doc_id") % 2).alias("page_count"))
    return records.fallback_page_stats(s, ["en", "de"]).select("doc_id", "page", "decision", "source", "lang", "chars", "ocr_conf", "columns_count", "has_table")


@query("""WITH a AS (SELECT conv_id AS doc_id, turn AS page, (500 + turn)::DOUBLE AS width, NULL::DOUBLE AS height, (turn * 90 % 360)::DOUBLE AS rotation FROM conversations WHERE turn > 0),
b AS (SELECT conv_id AS doc_id, turn AS page, (CASE WHEN conv_id % 2 = 0 THEN 600 + conv_id % 7 END)::DOUBLE AS width, (800 + turn)::DOUBLE AS height FROM conversations WHERE turn % 2 = 0 AND turn > 0)
SELECT doc_id, page, coalesce(b.width, a.width) AS width, b.height, rotation FROM a LEFT JOIN b USING (doc_id, page)""")
def page_geometry(spark, d):
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"))
    none = {g: F.lit(None).cast("double") for g in records.GEOMETRY}
    a = c.withColumns(none | {"width": 500 + F.col("page"), "rotation": F.col("page") * 90 % 360})
    b = c.where("page % 2 = 0").withColumns(none | {"width": F.when(F.col("doc_id") % 2 == 0, 600 + F.col("doc_id") % 7), "height": 800 + F.col("page")})
    return records.page_geometry([a, b]).select("doc_id", "page", "width", "height", "rotation")


@query("""WITH v AS (SELECT user_id, event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id % 6 END AS p, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events),
f AS (SELECT user_id, p, min(r) AS r FROM v WHERE p > 0 GROUP BY user_id, p) SELECT u.user_id, coalesce(string_agg(p::VARCHAR, ',' ORDER BY r), '') AS pages FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN f USING (user_id) GROUP BY u.user_id""")
def multi_column_pages(spark, d):
    e = table(spark, d, "events").select("user_id", F.struct("event_id", F.when(F.col("event_id") % 4 == 0, "x").otherwise((F.col("event_id") % 6).cast("string")).alias("p")).alias("s"))
    g = e.groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list("s")), lambda x: x["p"]).alias("v"))
    return g.select("user_id", F.array_join(records.page_list(F.col("v")), ",").alias("pages"))


@query(f"WITH {LINES}, s AS (SELECT doc_id, string_agg(line, '|' ORDER BY block) AS all_ FROM l GROUP BY doc_id) SELECT d.doc_id, CASE d.doc_id % 4 WHEN 0 THEN coalesce(s.all_, '') WHEN 1 THEN d.source WHEN 2 THEN d.text ELSE coalesce(array_to_string(list_filter(regexp_split_to_array(d.text, '\\r\\n|[\\n\\x0b\\x0c\\r\\x1c\\x1d\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda x: x <> ''), '|'), '') END AS said FROM documents d LEFT JOIN s USING (doc_id)")
def text_lines(spark, d):
    x, kind = table(spark, d, "documents"), F.col("doc_id") % 4
    lines = F.when(kind == 0, F.concat(T.lines(F.col("text")), F.array(F.lit(None)))).when(kind == 2, F.array(F.lit(None).cast("string")))
    said = records.text_lines(lines, F.when(kind == 1, F.col("source")), F.when(kind >= 2, F.col("text")))
    return x.select("doc_id", F.array_join(said, "|").alias("said"))


# ---- files, schemas


@query(f"WITH {_SAMPLE}, t AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'docx' WHEN doc_id % 7 = 0 THEN ' Image ' WHEN scanned THEN 'pdf_scanned' WHEN mixed THEN 'pdf_mixed' ELSE 'pdf_text' END AS k FROM d), r AS (SELECT doc_id, CASE k WHEN ' Image ' THEN 'image' WHEN 'pdf_scanned' THEN 'pdf_scan' WHEN 'pdf_mixed' THEN 'pdf_scan_hybrid' ELSE k END AS reader_type FROM t) SELECT *, CASE WHEN reader_type = 'docx' THEN 'docx_emus' WHEN reader_type = 'image' THEN 'image_pixels' ELSE 'pdf_points' END AS unit FROM r")
def reader_types(spark, d):
    t = detection.pdf_types(_metrics(spark, d))
    kind = F.when(F.col("doc_id") % 4 == 0, "docx").when(F.col("doc_id") % 7 == 0, " Image ").otherwise(F.col("file_type"))
    return t.select("doc_id", detect.reader_type(kind).alias("reader_type")).withColumn("unit", detect.coordinate_unit(F.col("reader_type")))


_FILES = "f AS (SELECT page_id, ['in/a', 'Desktop/b', 'outputs/c', 'xDesktop/d', 'Downloads/e'][1 + page_id % 5] || page_id || ['.txt', '.docx', '.png', '.zzz'][1 + page_id % 4] AS path FROM pages)"


def _files(spark, d):
    pick = lambda values, by: F.get(F.array(*map(F.lit, values)), (F.col("page_id") % by).cast("int"))
    return table(spark, d, "pages").select("page_id", F.concat(pick(("in/a", "Desktop/b", "outputs/c", "xDesktop/d", "Downloads/e"), 5), F.col("page_id").cast("string"), pick((".txt", ".docx", ".png", ".zzz"), 4)).alias("path"), F.length("html").alias("length"))


@query(f"WITH {_FILES} SELECT page_id, regexp_extract(path, '^(Desktop/|Downloads/|outputs/)', 1) AS prefix FROM f WHERE regexp_matches(path, '^(Desktop/|Downloads/|outputs/)')")
def forbidden_paths(spark, d):
    return _files(spark, d).select("page_id", detect.forbidden(F.col("path")).alias("prefix")).where("prefix is not null")


@query(f"""WITH {_FILES} SELECT path, CASE WHEN page_id % 4 = 0 AND page_id % 3 <> 0 THEN 'norm/' || page_id ELSE path END AS effective_path, ['txt', 'docx', 'image', 'unknown'][1 + page_id % 4] AS file_type, ['native', 'native', 'ocr', 'mixed'][1 + page_id % 4] AS mode,
CASE WHEN page_id % 4 <> 0 THEN 'detect' END AS tables_mode, CASE WHEN page_id % 4 = 2 THEN 320 END::INT AS dpi, CASE WHEN page_id % 4 = 2 THEN 6 END::INT AS psm, 'deu+eng' AS lang FROM f""")
def readers_items(spark, d):
    f = _files(spark, d)
    normalized = f.where("page_id % 4 = 0 and page_id % 3 <> 0").select("path", F.concat(F.lit("norm/"), F.col("page_id").cast("string")).alias("normalized_path"))
    return chain.readers_items(chain.detected(f), normalized).select("path", "effective_path", "file_type", "mode", "tables_mode", "dpi", "psm", "lang")


@query("""WITH o AS (SELECT page_id AS name, CASE page_id % 3 WHEN 0 THEN true WHEN 2 THEN false END AS a FROM pages), n AS (SELECT page_id AS name, CASE WHEN page_id % 2 = 0 THEN false END AS b FROM pages WHERE page_id % 11 <> 0)
SELECT o.name, CASE WHEN n.name IS NULL THEN 'schema_removed' ELSE 'additional_properties_disabled' END AS kind FROM o LEFT JOIN n ON n.name = o.name WHERE n.name IS NULL OR (coalesce(a, true) AND NOT coalesce(b, true))""")
def schema_diff(spark, d):
    p = table(spark, d, "pages").select(F.col("page_id").alias("name"))
    old = p.withColumn("additional_properties", F.when(F.col("name") % 3 == 0, True).when(F.col("name") % 3 == 2, False))
    new = p.where("name % 11 <> 0").withColumn("additional_properties", F.when(F.col("name") % 2 == 0, False))
    return contracts.compare_schemas(old, new)


@query("SELECT doc_id, source || '.jsonl' AS file, CASE WHEN length(source) % 2 = 0 THEN 'of_' || source ELSE 'minimal' END AS schema FROM documents WHERE source IS NOT NULL")
def artifact_schemas(spark, d):
    x = table(spark, d, "documents").where("source is not null").select("doc_id", F.concat("source", F.lit(".jsonl")).alias("file"))
    schemas = x.select("file", F.concat(F.lit("of_"), F.substring_index("file", ".jsonl", 1)).alias("schema")).where("length(file) % 2 = 0").distinct()
    return contracts.schema_of(x, schemas)


@query("SELECT doc_id, sha256(nfc_normalize(text)) AS sha FROM documents")
def nfc_digest(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(T.nfc(F.col("text")), 256).alias("sha"))


_BYTES = (1000.0, 10000.0, 100000.0, 500000.0, 1e6, 5e6, 1e7, 5e7, 1e8)


@query(f"SELECT lang AS type, le, count(*) FILTER (WHERE octet_length(encode(text)) <= le) AS n FROM documents CROSS JOIN (SELECT unnest([{', '.join(map(str, _BYTES))}, 'inf'::DOUBLE]::DOUBLE[]) AS le) GROUP BY lang, le")
def processed_documents(spark, d):
    x = table(spark, d, "documents").select(F.col("lang").alias("type"), F.octet_length("text").alias("value"))
    return metrics.histogram(x, _BYTES, ["type"])


@query(f"""SELECT 'documents_bytes_bucket{{' || CASE WHEN lang IS NULL THEN '' ELSE 'type="' || lang || '",' END || 'le="' || CASE WHEN isinf(le) THEN '+Inf' ELSE le::BIGINT::VARCHAR END || '"}} ' || count(*) FILTER (WHERE octet_length(encode(text)) <= le) AS line
FROM documents CROSS JOIN (SELECT unnest([{', '.join(map(str, _BYTES))}, 'inf'::DOUBLE]::DOUBLE[]) AS le) GROUP BY lang, le""")
def metric_lines(spark, d):
    return metrics.exposition(processed_documents(spark, d), "documents_bytes_bucket", ["type", "le"], "n").select("line")


# ---- logs and metrics


@query("SELECT event_id, 'https://t/x?id=' || md5(event_id::VARCHAR) AS url FROM events WHERE user_id % 3 <> 0")
def trace_urls(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("user_id") % 3 != 0, F.md5(F.col("event_id").cast("string").cast("binary"))).alias("trace_id"))
    return e.select("event_id", T.trace_url(F.lit(" https://t/x?id={trace_id} "), F.col("trace_id")).alias("url")).where("url is not null")


@query("SELECT event_id FROM events WHERE ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT < floor(0.3 * 4294967296)")
def trace_sample(spark, d):
    return metrics.sampled(table(spark, d, "events").select("event_id"), 0.3, "event_id")


@query(f"WITH {LOGS}, s AS (SELECT * FROM logs WHERE coalesce(level, '') <> 'INFO' AND regexp_full_match(coalesce(logger, ''), 'user[1-5]') AND NOT regexp_full_match(coalesce(phase, ''), 'phase_0[03]') AND coalesce(message, '') = 'error') SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, logger, count(*) AS n FROM s WHERE regexp_matches(message, '(?i)ERR') GROUP BY ALL")
def log_counts(spark, d):
    r = logs.select(log_records(table(spark, d, "events")), equal={"message": "error"}, unequal={"level": "INFO"}, like={"logger": "user[1-5]"}, unlike={"phase": "phase_0[03]"})
    return logs.count_over_time(logs.lines_with(r, "(?i)ERR"), "6 hours", ["logger"]).select("start", "logger", "n")


_DUPLICATES = f"""{LOGS}, o AS (SELECT event_id, level, logger, message, coalesce(code, '') AS code, epoch_us(ts) / 1e6::DOUBLE AS t, row_number() OVER (PARTITION BY logger, level, message, coalesce(code, '') ORDER BY ts, event_id) AS r FROM logs),
k AS (SELECT *, t AS last, true AS kept FROM o WHERE r = 1 UNION ALL SELECT o.*, CASE WHEN o.t - k.last >= 1800 THEN o.t ELSE k.last END, o.t - k.last >= 1800 FROM k JOIN o ON o.logger = k.logger AND o.level = k.level AND o.message = k.message AND o.code = k.code AND o.r = k.r + 1),
w AS (SELECT event_id, t FROM k WHERE kept)"""


def _handled(spark, d, handler):
    r = log_records(table(spark, d, "events")).select("event_id", "ts", "level", "logger", "message", "code", "run_id")
    seconds = (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).cast("double")
    return logs.handled(r, handler, seconds, ["ts", "event_id"], {"trace_id": "t1"}, ttl=1800, every=2, window=7200, most=3).select("event_id", "trace_id")


@query(f"WITH RECURSIVE {_DUPLICATES} SELECT event_id, 't1' AS trace_id FROM w")
def handler_file(spark, d):
    return _handled(spark, d, "json_file")


@query(f"""WITH RECURSIVE {_DUPLICATES}, s AS (SELECT event_id, t, row_number() OVER (ORDER BY t, event_id) AS r FROM (SELECT *, row_number() OVER (ORDER BY t, event_id) AS i FROM w) WHERE i % 2 = 0),
l AS (SELECT *, t AS start, 1 AS n FROM s WHERE r = 1 UNION ALL SELECT s.*, CASE WHEN s.t - l.start > 7200 THEN s.t ELSE l.start END, CASE WHEN s.t - l.start > 7200 THEN 1 ELSE l.n + 1 END FROM l JOIN s ON s.r = l.r + 1)
SELECT event_id, 't1' AS trace_id FROM l WHERE n <= 3""")
def handler_console(spark, d):
    return _handled(spark, d, "console")


_COUNTERS = "c AS (SELECT user_id % 50 AS u, epoch_us(ts) / 1e6 AS s, (row_number() OVER (PARTITION BY user_id % 50 ORDER BY ts, event_id) % 40)::DOUBLE AS v FROM events)"
_STEP, _RANGE = 3600, 21600
_GRID = f"g AS (SELECT u, unnest(range((ceil(min(s) / {_STEP}) * {_STEP})::BIGINT, (ceil(max(s) / {_STEP}) * {_STEP})::BIGINT + 1, {_STEP})) AS t FROM c GROUP BY u), m AS (SELECT g.u, g.t, c.s, c.v FROM g JOIN c ON c.u = g.u AND c.s > g.t - {_RANGE} AND c.s <= g.t)"


def _counters(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy(F.col("user_id") % 50).orderBy("ts", "event_id")
    return table(spark, d, "events").select((F.col("user_id") % 50).alias("u"), "ts", (F.row_number().over(w) % 40).cast("double").alias("value"))


@query(f"""WITH {_COUNTERS}, {_GRID}, x AS (SELECT *, lag(v) OVER (PARTITION BY u, t ORDER BY s, v) AS b FROM m),
y AS (SELECT u, t, count(*) AS n, min(s) AS a, max(s) AS z, arg_min(v, s * 1e3 + v / 1e3) AS f, sum(CASE WHEN b IS NULL THEN 0 WHEN v < b THEN v ELSE v - b END) AS raw FROM x GROUP BY u, t HAVING count(*) >= 2 AND max(s) > min(s)),
w AS (SELECT *, (z - a) / (n - 1) AS gap, a - (t - {_RANGE}) AS p, t - z AS q FROM y),
e AS (SELECT *, CASE WHEN p >= gap * 1.1 THEN gap / 2 ELSE p END AS p2, CASE WHEN q >= gap * 1.1 THEN gap / 2 ELSE q END AS q2 FROM w)
SELECT u, t, round(raw * (z - a + least(p2, CASE WHEN raw > 0 AND f >= 0 THEN (z - a) * f / raw ELSE p2 END) + q2) / (z - a), 6) AS increase FROM e""")
def sliding_increase(spark, d):
    return metrics.sliding_increase(_counters(spark, d), ["u"], _RANGE, _STEP).select("u", "t", F.round("increase", 6).alias("increase"))


@query(f"WITH {_COUNTERS}, {_GRID} SELECT u, t, round(avg(v), 9) AS average FROM m GROUP BY u, t")
def sliding_average(spark, d):
    return metrics.sliding_average(_counters(spark, d), ["u"], _RANGE, _STEP).select("u", "t", F.round("average", 9).alias("average"))


_MEASURED = "v AS (SELECT ts, 'phase_0' || (user_id % 3) AS phase, event_type AS kind, value * 10 AS ms, (user_id % 9 = 0)::INT AS failed, 'r' || (user_id % 4) AS route, CASE WHEN user_id % 2 = 0 THEN 'GET' ELSE 'PUT' END AS method FROM events)"


def _measured(spark, d):
    e = table(spark, d, "events").select(
        "ts", F.concat(F.lit("phase_0"), (F.col("user_id") % 3).cast("string")).alias("phase"), F.col("event_type").alias("kind"), (F.col("value") * 10).alias("ms"), (F.col("user_id") % 9 == 0).alias("failed"),
        F.concat(F.lit("r"), (F.col("user_id") % 4).cast("string")).alias("route"), F.when(F.col("user_id") % 2 == 0, "GET").otherwise("PUT").alias("method"),
    )
    return {"validations": e, "calls": e}


def _windowed(labels: str, ends: str) -> str:
    """SQL: the events of each window up to t, for the steps between the first and last of its labels."""
    key = f"{labels}, " if labels else ""
    on = " AND ".join(["v2.s > g.t - {r}".format(r=_RANGE), "v2.s <= g.t", *[f"v2.{c} = g.{c}" for c in labels.split(", ") if c]])
    return f"(SELECT {', '.join(['g.t', *['g.' + c for c in labels.split(', ') if c], 'v2.ms', 'v2.failed'])} FROM (SELECT {key}unnest(range((ceil(min(s) / {_STEP}) * {_STEP})::BIGINT, {ends} + 1, {_STEP})) AS t FROM v2 {('GROUP BY ' + labels) if labels else ''}) g JOIN v2 ON {on})"


def _quantile_sql(rule: str, labels: str, q: float) -> str:
    bounds = (5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000) if rule == "api_p95_ms" else (1, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000)
    b = ", ".join(f"({float(x)}::DOUBLE, {float(lo)}::DOUBLE)" for x, lo in zip(bounds, (0, *bounds)))
    said = "concat_ws(',', " + labels + ")" if labels else "''"
    key = f"{labels}, " if labels else ""
    return f"""SELECT '{rule}' AS rule, {said} AS labels, t, arg_min(CASE WHEN isinf(le) THEN lo ELSE lo + (le - lo) * ({q} * total - below) / (n - below) END, le) AS value FROM (
      SELECT *, max(n) OVER (PARTITION BY {key}t) AS total, coalesce(lag(n) OVER (PARTITION BY {key}t ORDER BY le), 0) AS below FROM (
        SELECT {key}t, le, lo, count(*) FILTER (WHERE ms <= le) AS n FROM {_windowed(labels, f"(ceil(max(s) / {_STEP}) * {_STEP})::BIGINT")} CROSS JOIN (VALUES {b}, ('inf'::DOUBLE, {float(bounds[-1])})) k(le, lo) GROUP BY ALL))
      WHERE total > 0 AND n >= {q} * total GROUP BY {key}t"""


_RULES = " UNION ALL ".join(
    _quantile_sql(name, ", ".join(labels), q) if q else f"SELECT '{name}' AS rule, concat_ws(',', {', '.join(labels)}) AS labels, t, avg(failed) AS value FROM {_windowed(', '.join(labels), f'(ceil(max(s) / {_STEP}) * {_STEP})::BIGINT')} GROUP BY ALL"
    for name, (_, labels, q) in rules.RECORDED.items()
)


@query(f"WITH {_MEASURED}, v2 AS (SELECT *, epoch_us(ts) / 1e6 AS s FROM v) SELECT rule, labels, t, round(value, 6) AS value FROM ({_RULES})")
def recorded_series(spark, d):
    t, out = _measured(spark, d), None
    for name in rules.RECORDED:
        x = rules.recorded(name, t, _RANGE, _STEP)
        out = x if out is None else out.unionByName(x)
    return out.withColumn("value", F.round("value", 6))


@query(f"""WITH v AS (SELECT epoch_us(ts) / 1e6 AS s, (user_id % 9 = 0)::INT AS failed FROM events), g AS (SELECT unnest(range((ceil(min(s) / 3600) * 3600)::BIGINT, (ceil(max(s) / 3600) * 3600)::BIGINT + 1, 3600)) AS t FROM v),
b AS (SELECT speed, t, avg(failed) / 0.02 AS burn, most FROM g CROSS JOIN (VALUES ('fast', 3600, 5.0), ('slow', 43200, 1.0)) k(speed, w, most) JOIN v ON v.s > t - w AND v.s <= t GROUP BY ALL)
SELECT speed, t, round(burn, 6) AS burn, burn > most AS firing FROM b""")
def slo_burns(spark, d):
    return rules.burns(_measured(spark, d)["validations"], 3600, 12).withColumn("burn", F.round("burn", 6))


# ---- functions over whole tables whose odd cases stand in the registry's queries on literals


@query(rf"WITH {LINES} SELECT doc_id, block, CASE WHEN regexp_matches(line, '^[-*+] ') THEN substr(line, 1, 1) WHEN regexp_matches(line, '(?s)^[\p{{Nd}}\p{{L}}][.)].') THEN substr(line, 1, 2) ELSE '' END AS marker FROM l")
def line_markers(spark, d):
    x = table(spark, d, "documents").select("doc_id", F.posexplode(T.lines(F.col("text"))).alias("block", "line"))
    return x.select("doc_id", F.col("block").cast("long").alias("block"), T.numbering_marker(F.col("line")).alias("marker"))


_PARTS = ("de", "EN ", "fr", "mixed", "", "ger", "eng")


@query(f"""WITH t AS (SELECT event_id, [{', '.join(f"'{p}'" for p in _PARTS)}] AS p, ['de', 'en', NULL, 'mixed', NULL, 'de', 'en'] AS k FROM events), s AS (SELECT event_id, k[1 + event_id % 7] AS a, k[1 + event_id // 7 % 7] AS b FROM t)
SELECT event_id, CASE WHEN 'mixed' IN (coalesce(a, ''), coalesce(b, '')) OR (a <> b) THEN 'de+en' ELSE coalesce(a, b, 'de') END AS lang FROM s""")
def tags_of_rows(spark, d):
    part = lambda c: F.get(F.array(*map(F.lit, _PARTS)), F.expr(c).cast("int"))
    e = table(spark, d, "events").select("event_id", F.concat_ws(",", part("event_id % 7"), part("event_id div 7 % 7")).alias("tags"))
    return e.select("event_id", T.collapse_tokens(T.language_tokens(F.col("tags"))).alias("lang"))


@query(f"WITH t AS (SELECT conv_id, turn, {_hint(_tokens('text'))} AS h FROM conversations) SELECT a.conv_id, a.turn, CASE WHEN a.h = b.h OR b.h = 'unknown' THEN a.h WHEN a.h = 'unknown' THEN b.h ELSE 'mixed' END AS merged FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1")
def hints_of_turns(spark, d):
    x = table(spark, d, "conversations").select("conv_id", "turn", T.words_ascii(F.col("text")).alias("w")).select("conv_id", "turn", T.language_hint_of(F.col("w")).alias("h"))
    y = x.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("h").alias("g"))
    return x.join(y, ["conv_id", "turn"]).select("conv_id", "turn", T.merge_hints(F.col("h"), F.col("g")).alias("merged"))


_VERSION = "concat_ws('.', user_id % 4, event_id % 13, user_id % 17)"


@query("SELECT event_id, CASE event_type WHEN 'error' THEN (user_id % 4 + 1) || '.0.0' WHEN 'view' THEN (user_id % 4) || '.' || (event_id % 13 + 1) || '.0' ELSE (user_id % 4) || '.' || (event_id % 13) || '.' || (user_id % 17 + 1) END AS bumped, CASE event_type WHEN 'error' THEN 'major' WHEN 'view' THEN 'minor' ELSE 'patch' END AS kind FROM events")
def versions_of_rows(spark, d):
    kind = F.when(F.col("event_type") == "error", "major").when(F.col("event_type") == "view", "minor").otherwise("patch")
    e = table(spark, d, "events").withColumns({"v": F.expr(_VERSION), "k": kind}).withColumn("bumped", T.bump(F.col("v"), F.col("k")))
    return e.select("event_id", "bumped", T.bump_kind(F.col("v"), F.col("bumped")).alias("kind"))


@query("SELECT max(user_id % 4 * 1000000 + event_id % 13 * 1000 + user_id % 17) AS best FROM events WHERE (user_id % 4, event_id % 13, user_id % 17) < (2, 5, 3)")
def highest_below(spark, d):
    v = contracts.version_below(table(spark, d, "events").select(F.concat(F.lit("v"), F.expr(_VERSION)).alias("tag")), "v2.5.3").select(T.semver(F.col("tag")).alias("s"))
    return v.select((F.col("s.major") * 1000000 + F.col("s.minor") * 1000 + F.col("s.patch")).cast("long").alias("best"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN user_id ELSE 0 END::INT AS i, CASE event_id % 4 WHEN 0 THEN user_id WHEN 1 THEN user_id + 0.5 ELSE 0 END::DOUBLE AS f FROM events")
def numbers_of_rows(spark, d):
    u = F.col("user_id").cast("string")
    v = F.when(F.col("event_id") % 4 == 0, u).when(F.col("event_id") % 4 == 1, F.concat(u, F.lit(".5"))).when(F.col("event_id") % 4 == 2, F.concat(F.lit("n"), u)).otherwise("")
    return table(spark, d, "events").select("event_id", values.as_int(v).cast("int").alias("i"), values.as_float(v).cast("double").alias("f"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 OR user_id % 6 = 0 THEN 'major' WHEN event_type = 'view' THEN 'minor' ELSE 'patch' END AS kind FROM events")
def subjects_of_rows(spark, d):
    kind = F.when(F.col("event_type") == "view", "feat").otherwise(F.col("event_type"))
    subject = F.concat(kind, F.when(F.col("user_id") % 2 == 0, "(part)").otherwise(""), F.when(F.col("event_id") % 5 == 0, "!").otherwise(""), F.lit(": work"), F.when(F.col("user_id") % 6 == 0, "\n\nBREAKING CHANGE: x").otherwise(""))
    return table(spark, d, "events").select("event_id", values.commit_kind(subject).alias("kind"))


@query("""WITH t AS (SELECT event_id, ['ok', 'fallback', 'detect', 'failed', 'inadmissible', NULL][1 + event_id % 6] AS status, (user_id % 4)::INT AS rows, (event_id % 5)::INT AS cols, (user_id * 3)::INT AS cells FROM events)
SELECT event_id, round(least(1, greatest(0, CASE coalesce(status, 'failed') WHEN 'ok' THEN 0.85 WHEN 'inadmissible' THEN 0.1 WHEN 'failed' THEN 0.2 ELSE 0.6 END + 0.25::DOUBLE * least(cells / 200.0::DOUBLE, 1) + CASE WHEN least(rows, cols) >= 2 THEN 0.25 WHEN least(rows, cols) >= 1 THEN 0.1 ELSE 0 END))::DOUBLE, 9) AS confidence FROM t""")
def tables_of_rows(spark, d):
    status = F.get(F.array(*map(F.lit, ("ok", "fallback", "detect", "failed", "inadmissible", None))), (F.col("event_id") % 6).cast("int"))
    e = table(spark, d, "events").select("event_id", status.alias("status"), (F.col("user_id") % 4).cast("int").alias("r"), (F.col("event_id") % 5).cast("int").alias("c"), (F.col("user_id") * 3).cast("int").alias("n"))
    return e.select("event_id", F.round(layout.table_confidence(F.col("status"), F.col("r"), F.col("c"), F.col("n")).cast("double"), 9).alias("confidence"))


@query("""WITH p AS (SELECT page_id, page_id % 2 = 0 AS o_req, page_id % 3 = 0 AS n_req, page_id % 7 <> 0 AS n_there, page_id % 5 AS k FROM pages)
SELECT 'p' || page_id AS property, unnest(list_filter([CASE WHEN o_req AND NOT (n_req AND n_there) THEN 'required_removed' END, CASE WHEN n_req AND n_there AND NOT o_req THEN 'required_added' END, CASE WHEN NOT n_there THEN 'property_removed' END,
  CASE WHEN n_there AND k = 1 THEN 'type_narrowed' END, CASE WHEN n_there AND k = 2 THEN 'enum_shrunk' END], lambda x: x IS NOT NULL)) AS kind FROM p""")
def property_diff(spark, d):
    p = table(spark, d, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("property"), "page_id", (F.col("page_id") % 5).alias("k"))
    words = lambda when, more: F.when(when, F.array(F.lit("string"), F.lit("null"))).otherwise(F.array(F.lit("string"))) if more else F.array(F.lit("string"))
    enum = lambda *v: F.when(F.col("k") == 2, F.array(*map(F.lit, v)))
    old = p.select("property", words(F.col("k") == 1, True).alias("types"), enum("x", "y").alias("enum"), (F.col("page_id") % 2 == 0).alias("required"))
    new = p.where("page_id % 7 <> 0").select("property", words(None, False).alias("types"), enum("x").alias("enum"), (F.col("page_id") % 3 == 0).alias("required"))
    return contracts.compare(old, new)


_REPORT = """x AS (SELECT conv_id AS doc_id, turn + 1 AS page, ['native', 'OCR', 'native+ocr', ''][1 + turn % 4] AS source, CASE WHEN turn % 3 = 0 THEN 'ocr-' || turn ELSE '' END AS decision, length(text) AS chars,
  ['de', 'eng', 'mixed', 'fr', NULL][1 + (conv_id + turn) % 5] AS lang, CASE WHEN turn % 4 <> 3 THEN (40 + (conv_id * 7 + turn) % 60)::DOUBLE END AS conf, turn % 2 * 30 AS words, turn % 3 AS tables, conv_id % 9 * 100 AS rot,
  turn % 5 > 0 AS geo, conv_id % 2 = 0 AS shared, (turn - 2) / 4::DOUBLE AS noise FROM conversations),
y AS (SELECT *, CASE WHEN lang IN ('de') THEN 'de' WHEN lang = 'eng' THEN 'en' ELSE 'de+en' END AS l, CASE source WHEN 'native' THEN 'text' WHEN 'OCR' THEN 'ocr' WHEN 'native+ocr' THEN 'mixed' ELSE CASE WHEN turn_ocr THEN 'ocr' ELSE 'text' END END AS kind FROM (SELECT *, decision <> '' AS turn_ocr FROM x))"""


@query(f"""WITH {_REPORT} SELECT doc_id, page, kind AS source, chars, l AS lang, round(CASE WHEN shared THEN 0.25 WHEN l = 'de+en' THEN 0.5 WHEN l = 'de' THEN 1 ELSE 0 END::DOUBLE, 4) AS de, round(CASE WHEN shared THEN 0.75 WHEN l = 'de+en' THEN 0.5 WHEN l = 'en' THEN 1 ELSE 0 END::DOUBLE, 4) AS en,
coalesce(conf, 0)::DOUBLE AS ocr_conf, words::INT AS ocr_words, tables::INT AS tables_found, array_to_string(list_filter(['given', CASE WHEN conf < 70 THEN 'low_conf_page' END, CASE WHEN conf >= 70 AND words < 10 THEN 'low_text_page' END, CASE WHEN kind = 'text' AND chars < 200 THEN 'suspicious_text_page' END], lambda f: f IS NOT NULL), ',') AS flags,
CASE WHEN geo THEN (round_even(rot / 90.0, 0) * 90)::INT % 360 ELSE 0 END::INT AS rotation_deg, doc_id % 3 = 0 AND page % 2 = 0 AS is_multi_column, CASE WHEN doc_id % 3 = 0 AND page % 2 = 0 THEN 2 ELSE 1 END AS columns_count,
CASE WHEN geo THEN 600 ELSE 0 END::DOUBLE AS width, least(1, greatest(0, noise))::DOUBLE AS noise_score, CASE WHEN geo THEN round(chars / 480000.0::DOUBLE, 6) ELSE 0 END::DOUBLE AS text_density, doc_id % 5 = 0 AS has_header_footer, geo AND doc_id % 4 > 0 AS has_images,
CASE WHEN decision <> '' THEN decision WHEN source <> '' THEN source ELSE 'text' END AS decision, tables > 0 AS has_table FROM y""")
def page_report(spark, d):
    c, turn, conv = table(spark, d, "conversations"), F.col("turn"), F.col("conv_id")
    pick = lambda values, i: F.get(F.array(*map(F.lit, values)), i.cast("int"))
    base = c.select(conv.alias("doc_id"), (turn + 1).alias("page"), "turn", F.length("text").alias("chars"))
    doc, t = F.col("doc_id"), F.col("turn")
    pages = base.withColumns({
        "source": pick(("native", "OCR", "native+ocr", ""), t % 4), "decision": F.when(t % 3 == 0, F.concat(F.lit("ocr-"), t.cast("string"))).otherwise(""), "lang": pick(("de", "eng", "mixed", "fr", None), (doc + t) % 5),
        "locale": F.lit("de"), "ocr_conf": F.when(t % 4 != 3, 40 + (doc * 7 + t) % 60), "ocr_words": t % 2 * 30, "tables_found": t % 3, "table_cells": F.lit(0), "has_table": F.lit(False), "time_ms": F.lit(1.234),
        "skew_deg": F.lit(0.0), "noise_score": (t - 2) / 4, "flags": F.array(F.lit(" given "), F.lit("")),
    }).drop("turn")
    at = base.select("doc_id", "page", "turn")
    geometry = at.where("turn % 5 > 0").select("doc_id", "page", F.lit(600).alias("width"), F.lit(800).alias("height"), (doc % 9 * 100).alias("rotation"), (doc % 4).alias("images_count"), F.lit(0).alias("graphics_objects_count"))
    shares = at.where("doc_id % 2 = 0").select("doc_id", "page", F.lit(0.25).alias("de"), F.lit(0.75).alias("en"))
    zones = at.select("doc_id", "page", (doc % 5 == 0).alias("has_header_footer"))
    r = readers.page_report(pages, geometry, shares, zones, at.where("doc_id % 3 = 0 and page % 2 = 0"), "de,en")
    return r.select(
        "doc_id", "page", "source", "chars", "lang", "lang_share.de", "lang_share.en", "ocr_conf", "ocr_words", "tables_found", F.array_join("flags", ",").alias("flags"), "rotation_deg", "is_multi_column", "columns_count",
        "page_size.width", "noise_score", "text_density", "has_header_footer", "has_images", "decision", "has_table",
    )


_LEVELS = {series: {">": threshold, "<": threshold, "==": 1.0}[op] for series, op, threshold, _, _ in rules.ALERTS.values()}


def _levels(spark, d):
    """Every series of the alert rules, by hours and a label: a level around its threshold (0 and 1 for one that is or is not there)."""
    e = table(spark, d, "events").select((F.ceil(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 / 3600) * 3600).cast("long").alias("t"), (F.col("user_id") % 3).cast("string").alias("labels"), "user_id")
    h = e.groupBy("t", "labels").agg(((F.sum("user_id") % 10) / 5).alias("x"))
    one = lambda s, level: F.struct(F.lit(s).alias("series"), (F.floor(F.col("x")).cast("double") if s == "up" else (F.col("x") - 0.9) if level == 0 else F.col("x") * level).alias("value"))
    return h.select("t", "labels", F.explode(F.array(*[one(s, v) for s, v in _LEVELS.items()])).alias("s")).select("t", "labels", "s.*")


_FIRED = "h AS (SELECT (ceil(epoch_us(ts) / 1e6 / 3600) * 3600)::BIGINT AS t, (user_id % 3)::VARCHAR AS labels, sum(user_id) % 10 / 5 AS x FROM events GROUP BY ALL), z AS (" + " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, '{sev}' AS severity, {hold} AS hold, labels, t FROM h WHERE " + ("floor(x) = 0" if series == "up" else f"x - 0.9 {op} 0" if threshold == 0 else f"x * {threshold}::DOUBLE {op} {threshold}::DOUBLE")
    for rule, (series, op, threshold, hold, sev) in rules.ALERTS.items()
) + "), i AS (SELECT *, t - 3600 * row_number() OVER (PARTITION BY rule, labels ORDER BY t) AS island FROM z), a AS (SELECT rule, severity, labels, min(t) AS begins, max(t) AS ends FROM i GROUP BY rule, severity, labels, island, hold HAVING max(t) - min(t) >= hold * 12)"


@query(f"WITH {_FIRED} SELECT * FROM a")
def alert_rules(spark, d):
    return rules.fired(_levels(spark, d), 3600, 12)


@query(f'WITH {_FIRED} SELECT rule, severity, labels, unnest(range(begins + 30, greatest(ends, begins + 30) + 1, 3600)) AS "at" FROM a')
def alert_notifications(spark, d):
    return rules.notified(rules.fired(_levels(spark, d), 3600, 12))
