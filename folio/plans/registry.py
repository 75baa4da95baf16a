"""Every query of the engine, with the DuckDB SQL that it must equal where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio import constants as K
from folio.functions import detect, encoding, geometry, values
from folio.functions import text as T
from folio.operators import contracts, detection, layout, logs, metrics, readers
from folio.plans.views import BOXES, LOGS, boxes, log_records, numbers, table
from folio.sources import files

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if oracle:
            _ORACLE[f.__name__] = oracle
        return f

    return keep


def queries() -> dict[str, Query]:
    from folio.plans import alerts, charsets, documents, more, pdfs, rasters, rows  # noqa: F401

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from folio.plans import alerts, charsets, documents, more, pdfs, rasters, rows  # noqa: F401

    return dict(_ORACLE)


# ---- pieces of SQL


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _tokens(x: str) -> str:
    return f"list_filter(string_split(lower(regexp_replace(coalesce({x}, ''), '[^A-Za-z0-9 ]', ' ', 'g')), ' '), lambda w: w <> '')"


def _hint(tokens: str) -> str:
    pairs = " OR ".join(f"contains(w, '{p}')" for p in K.GERMAN_PAIRS)
    de = f"(len(list_filter({tokens}, lambda w: w IN ({_list(K.GERMAN_WORDS)}) OR {pairs})) + list_has_any({tokens}, [{_list(K.GERMAN_MONTHS)}])::INT)"
    en = f"(len(list_filter({tokens}, lambda w: w IN ({_list(K.ENGLISH_WORDS)}))) + list_has_any({tokens}, [{_list(K.ENGLISH_MONTHS)}])::INT)"
    return f"CASE WHEN {de} = 0 AND {en} = 0 THEN 'unknown' WHEN {de} > 0 AND {en} > 0 AND abs({de} - {en}) <= 1 THEN 'mixed' WHEN {de} > {en} THEN 'de' ELSE 'en' END"


def _locale(x: str) -> str:
    de, en = f"(regexp_matches({x}, '{K.GERMAN_DATE}') OR regexp_matches({x}, '{K.GERMAN_AMOUNT}'))", f"(regexp_matches({x}, '{K.ENGLISH_DATE}') OR regexp_matches({x}, '{K.ENGLISH_AMOUNT}'))"
    return f"CASE WHEN {de} AND {en} THEN 'mixed' WHEN {de} THEN 'de' WHEN {en} THEN 'en' ELSE 'unknown' END"


def _words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> ''))"


def _lines(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda w: trim(w, ' ' || chr(9) || chr(13))), lambda w: w <> '')"


def _count(x: str, cls: str) -> str:
    return f"len(regexp_extract_all({x}, '{cls}'))"


def _upper(x: str) -> str:
    return f"CASE WHEN {_count(x, r'\p{L}')} > 0 THEN {_count(x, r'\p{Lu}')} / {_count(x, r'\p{L}')}::DOUBLE ELSE 0 END"


def _heading(x: str) -> str:
    return f"({x} <> '' AND {_words(x)} <= 12 AND ((({_upper(x)}) >= 0.6 AND {_words(x)} <= 8) OR (({_upper(x)}) >= 0.4 AND {_words(x)} <= 6)))"


LISTED = r"'^([-*+] |•)'"
NUMBERED = r"'^([0-9]+|[a-zA-Z])[).]\s'"
TOKENS = f"t AS (SELECT *, {_tokens('text')} AS toks FROM documents)"
LINES = f"l AS (SELECT doc_id, unnest({_lines('text')}) AS line, unnest(range(len({_lines('text')}))) AS block FROM documents)"
PAGES = f"""p AS (SELECT conv_id AS doc_id, (turn + 1)::INT AS page, CASE WHEN role = 'assistant' THEN 'ocr' ELSE 'native' END AS source, text, {_words('text')} AS words, length(text) AS chars,
  len({_lines('text')}) AS blocks, {_tokens('text')} AS toks FROM conversations),
q AS (SELECT * EXCLUDE (n3), CASE WHEN trim(text) = '' THEN 0 ELSE least((n3 // 30 + (n3 % 30 > 15 OR (n3 % 30 = 15 AND n3 // 30 % 2 = 1))::INT) / 100.0::DOUBLE, 96.0) END AS conf,
  {_hint('toks')} AS hint, {_locale('text')} AS locale FROM (SELECT *, 165000 + 7500 * least(blocks, 8) + 375 * least(words, 120) + 20 * least(chars, 1500) AS n3 FROM p))"""


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return readers.turn_pages(table(spark, d, "conversations"))


# ---- text


@query(f"WITH {TOKENS}, h AS (SELECT {_hint('toks')} AS hint, {_locale('text')} AS locale, {_words('text')} AS words, length(text) AS chars FROM t) SELECT hint, locale, count(*) AS documents, sum(words)::BIGINT AS words, sum(chars)::BIGINT AS chars FROM h GROUP BY hint, locale")
def entry_language_profile(spark: SparkSession, d: str) -> DataFrame:
    x = _docs(spark, d).select(T.words_ascii(F.col("text")).alias("toks"), T.locale_hint(F.col("text")).alias("locale"), T.word_count(F.col("text")).alias("words"), F.length("text").alias("chars"))
    return x.select(T.language_hint_of(F.col("toks")).alias("hint"), "locale", "words", "chars").groupBy("hint", "locale").agg(F.count(F.lit(1)).alias("documents"), F.sum("words").alias("words"), F.sum("chars").alias("chars"))


@query(f"WITH {TOKENS} SELECT doc_id, {_hint('toks')} AS hint FROM t")
def language_hint(spark, d):
    return _docs(spark, d).select("doc_id", T.words_ascii(F.col("text")).alias("toks")).select("doc_id", T.language_hint_of(F.col("toks")).alias("hint"))


@query(f"SELECT doc_id, {_locale('text')} AS locale FROM documents")
def locale_hint(spark, d):
    return _docs(spark, d).select("doc_id", T.locale_hint(F.col("text")).alias("locale"))


@query(f"SELECT doc_id, {_words('text')} AS words, length(text) AS chars FROM documents")
def word_count(spark, d):
    return _docs(spark, d).select("doc_id", T.word_count(F.col("text")).alias("words"), F.length("text").alias("chars"))


@query(f"WITH {LINES} SELECT doc_id, block, line, {_heading('line')} AS heading FROM l")
def heading_like(spark, d):
    x = _docs(spark, d).select("doc_id", F.posexplode(T.lines(F.col("text"))).alias("block", "line"))
    return x.select("doc_id", F.col("block").cast("long").alias("block"), "line", T.heading_like(F.col("line"), F.lit(1)).alias("heading"))


@query(f"WITH {LINES} SELECT doc_id, count(*) FILTER (WHERE regexp_matches(line, {LISTED}) OR regexp_matches(line, {NUMBERED})) AS listed, count(*) FILTER (WHERE regexp_matches(line, {LISTED})) AS bullets FROM l GROUP BY doc_id")
def list_like(spark, d):
    x = _docs(spark, d).select("doc_id", F.explode(T.lines(F.col("text"))).alias("line"))
    return x.groupBy("doc_id").agg(F.count_if(T.list_like(F.col("line"))).alias("listed"), F.count_if(T.list_like(F.col("line"), compat=True)).alias("bullets"))


@query(f"SELECT doc_id, ({_upper('text')}) >= 0.75 AS is_upper, {_upper('text')} AS ratio FROM documents")
def upper_ratio(spark, d):
    return _docs(spark, d).select("doc_id", T.is_upper(F.col("text")).alias("is_upper"), T.upper_ratio(F.col("text")).cast("double").alias("ratio"))


@query(r"SELECT doc_id, len(list_filter(regexp_extract_all(text, '[\p{L}\p{Nd}_]+'), lambda w: regexp_full_match(w, '[\x00-\x7F]*'))) AS en, len(list_filter(regexp_extract_all(text, '[\p{L}\p{Nd}_]+'), lambda w: NOT regexp_full_match(w, '[\x00-\x7F]*'))) AS de FROM documents")
def script_counts(spark, d):
    return _docs(spark, d).select("doc_id", T.script_counts(F.col("text")).alias("s")).select("doc_id", "s.en", "s.de")


@query(f"""WITH {LINES} SELECT style, count(*) AS blocks, sum(length(line))::BIGINT AS chars FROM (SELECT line, CASE WHEN {_heading('line')} THEN 'heading' WHEN regexp_matches(line, {LISTED}) OR regexp_matches(line, {NUMBERED}) THEN 'list' ELSE 'body' END AS style FROM l) GROUP BY style""")
def paragraph_style(spark, d):
    b = readers.line_blocks(readers.text_pages(_docs(spark, d)))
    return b.groupBy(F.col("paragraph_style").alias("style")).agg(F.count(F.lit(1)).alias("blocks"), F.sum("char_count").alias("chars"))


@query(f"""WITH b AS (SELECT conv_id AS doc_id, turn, unnest({_lines('text')}) AS line, unnest(range(len({_lines('text')}))) AS i FROM conversations)
SELECT doc_id, (turn + 1)::INT AS page, line AS text, (row_number() OVER (PARTITION BY doc_id ORDER BY turn, i) - 1)::BIGINT AS reading_order_index FROM b""")
def reading_order(spark, d):
    b = readers.reading_order(readers.line_blocks(_pages(spark, d)))
    return b.select("doc_id", "page", "text", F.col("reading_order_index").cast("long").alias("reading_order_index"))


@query("SELECT doc_id, sha256(replace(replace(replace(text, chr(10), chr(13) || chr(10)), chr(13) || chr(10), chr(10)), chr(13), chr(10))) AS sha, length(replace(text, chr(10), chr(13) || chr(10))) AS crlf_chars FROM documents")
def newline_normalize(spark, d):
    x = _docs(spark, d).select("doc_id", "text", F.replace("text", F.lit("\n"), F.lit("\r\n")).alias("crlf"))
    return x.select("doc_id", F.sha2(encoding.newlines(F.col("crlf")), 256).alias("sha"), F.length(encoding.newlines(F.col("text"), "crlf")).alias("crlf_chars"))


_REDACT = "text"
for _p in K.SECRET_PATTERNS:
    _REDACT = f"regexp_replace({_REDACT}, '{_p}', '{K.REDACTED}', 'g')"


@query(f"SELECT doc_id, sha256({_REDACT}) AS sha, {_REDACT} <> text AS changed FROM documents")
def redact_text(spark, d):
    x = _docs(spark, d).select("doc_id", "text", T.redact(F.col("text")).alias("r"))
    return x.select("doc_id", F.sha2("r", 256).alias("sha"), (F.col("r") != F.col("text")).alias("changed"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def content_sha256(spark, d):
    return _docs(spark, d).select("doc_id", F.sha2("text", 256).alias("sha"))


# ---- detection and encoding

PATHS = "('a/report.pdf'), ('b.DOCX'), ('x.tar.gz'), ('.bashrc'), ('.a.txt'), ('notes.md'), ('scan.TIFF'), ('d/'), ('photo.webp'), ('c.conf'), ('noext'), ('e.')"
_EXT = r"lower(regexp_extract(regexp_extract(path, '[^/]*$'), '^\.*[^.].*?(\.[^.]*)$', 1))"
_MEDIA = "CASE e " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.MEDIA.items()) + " ELSE '' END"
_KIND = f"CASE WHEN e = '.pdf' THEN 'pdf_text' WHEN e = '.docx' THEN 'docx' WHEN e IN ({_list(K.TEXT)}) OR starts_with(m, 'text/') THEN 'txt' WHEN e IN ({_list(K.IMAGE)}) OR starts_with(m, 'image/') THEN 'image' ELSE 'unknown' END"
TYPED = f"p AS (SELECT url AS path FROM pages UNION ALL SELECT path FROM (VALUES {PATHS}) v(path)), x AS (SELECT path, {_EXT} AS e FROM p), m AS (SELECT *, {_MEDIA} AS m FROM x), k AS (SELECT path, e AS ext, m AS mime, {_KIND} AS file_type FROM m)"


def _paths(spark, d):
    return table(spark, d, "pages").select(F.col("url").alias("path")).unionByName(numbers(spark, PATHS, "path"))


@query(f"WITH {TYPED} SELECT path, ext, mime, file_type, file_type = 'image' AS ocr_recommended, CASE file_type WHEN 'pdf_text' THEN 0.5 WHEN 'unknown' THEN 0.3 ELSE 0.95 END::DOUBLE AS confidence, CASE WHEN file_type IN ('txt', 'docx') THEN 'encoding' ELSE 'skip' END AS route FROM k")
def detect_type(spark, d):
    x = _paths(spark, d).select("path", detect.extension(F.col("path")).alias("ext"), detect.media_type(F.col("path")).alias("mime"), detect.file_type(F.col("path")).alias("k"))
    return x.select("path", "ext", "mime", "k.file_type", "k.ocr_recommended", "k.confidence", detect.route(F.col("k.file_type")).alias("route"))


@query(f"WITH {TYPED} SELECT file_type, count(*) AS n FROM k GROUP BY file_type")
def detect_stage_stats(spark, d):
    return _paths(spark, d).groupBy(detect.file_type(F.col("path"))["file_type"].alias("file_type")).agg(F.count(F.lit(1)).alias("n"))


_VOTE = """v AS (SELECT conv_id AS doc_id, turn, length(text) AS len, {words} AS words, len({lines}) AS blocks, (conv_id + turn) % 3 AS images, ((conv_id * 7 + turn * 31) % 101) / 100.0::DOUBLE AS area FROM conversations),
s AS (SELECT *, (len >= 200)::INT + (words >= 15)::INT + (blocks >= 3)::INT AS native, (images >= 1)::INT + (area >= 0.35)::INT + (len < 200 AND words < 15)::INT AS ocr FROM v)""".format(words=_words("text"), lines=_lines("text"))


def _metrics(spark, d):
    c = table(spark, d, "conversations")
    return c.select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.length("text").alias("text_len"), T.word_count(F.col("text")).alias("words"), F.size(T.lines(F.col("text"))).alias("blocks"),
        ((F.col("conv_id") + F.col("turn")) % 3).alias("images"), (((F.col("conv_id") * 7 + F.col("turn") * 31) % 101) / 100.0).cast("double").alias("image_area"),
    )


@query(f"WITH {_VOTE} SELECT doc_id, turn, native AS native_score, ocr AS ocr_score, CASE WHEN native > ocr THEN 'native' WHEN ocr > native THEN 'ocr' ELSE 'unclear' END AS mode FROM s")
def page_vote(spark, d):
    return detection.voted(_metrics(spark, d)).select("doc_id", F.col("page").alias("turn"), "v.native_score", "v.ocr_score", "v.mode")


_SAMPLE = f"""{_VOTE}, n AS (SELECT *, max(turn) OVER (PARTITION BY doc_id) + 1 AS pages, row_number() OVER (PARTITION BY doc_id ORDER BY area DESC, turn) AS r, max(area) OVER (PARTITION BY doc_id) AS largest FROM s),
k AS (SELECT * FROM n WHERE r <= 2 OR turn IN (0, pages // 2, pages - 1)),
g AS (SELECT doc_id, any_value(pages)::INT AS pages, count(*) AS sampled, count(*) FILTER (WHERE native > ocr) AS n, count(*) FILTER (WHERE ocr > native) AS o, any_value(largest) AS largest FROM k GROUP BY doc_id),
z AS (SELECT *, n = 0 AND (o = sampled OR largest >= 0.9) AS scan, n > 0 AND o > 0 AS both_, n = sampled AND largest < 0.35 AS plain FROM g),
d AS (SELECT doc_id, pages, sampled, NOT scan AND (both_ OR largest >= 0.35) AS mixed, CASE WHEN scan THEN true WHEN both_ OR largest >= 0.35 OR plain THEN false END AS scanned,
  CASE WHEN scan OR (plain AND NOT both_) THEN 0.9 WHEN both_ THEN round(1.0 - 0.4 * abs(n - o) / (n + o)::DOUBLE, 3) WHEN largest >= 0.35 THEN 0.7 ELSE 0.5 END::DOUBLE AS confidence FROM z)"""


@query(f"WITH {_SAMPLE} SELECT doc_id, turn FROM k")
def page_sample(spark, d):
    return detection.sampled(_metrics(spark, d)).select("doc_id", F.col("page").alias("turn"))


@query(f"WITH {_SAMPLE} SELECT * FROM d")
def document_vote(spark, d):
    return detection.document_votes(_metrics(spark, d))


@query(f"WITH {_SAMPLE} SELECT doc_id, CASE WHEN scanned THEN 'pdf_scanned' WHEN mixed THEN 'pdf_mixed' ELSE 'pdf_text' END AS file_type, coalesce(scanned, false) OR mixed AS ocr_recommended, CASE WHEN scanned THEN 'ocr' WHEN mixed THEN 'mixed' ELSE 'native' END AS mode, CASE WHEN scanned THEN 320 WHEN mixed THEN 300 ELSE 200 END AS dpi, confidence FROM d")
def pdf_type(spark, d):
    return detection.pdf_types(_metrics(spark, d))


def _contents(spark, d):
    """Every third text has a byte order mark, every fifth is Latin-1 where that can hold it."""
    x = _docs(spark, d).select("doc_id", F.concat(F.lit("d/"), "doc_id", F.lit(".txt")).alias("path"), "text")
    latin = F.regexp_replace("text", r"[^\x00-\xFF]", "?")
    content = F.when(F.col("doc_id") % 5 == 0, F.encode(latin, "ISO-8859-1")).when(F.col("doc_id") % 3 == 0, F.concat(F.lit(b"\xef\xbb\xbf"), F.col("text").cast("binary"))).otherwise(F.col("text").cast("binary"))
    return x.select("doc_id", "path", content.alias("content"))


@query(r"""WITH l AS (SELECT doc_id, text, regexp_replace(text, '[^\x00-\x{FF}]', '?', 'g') AS latin FROM documents), x AS (SELECT doc_id, doc_id % 5 = 0 AND NOT regexp_full_match(latin, '(?s)[\x00-\x7F]*') AS odd, doc_id % 5 <> 0 AND doc_id % 3 = 0 AS bom, text, latin FROM l)
SELECT doc_id, CASE WHEN odd THEN 'iso-8859-1' ELSE 'utf-8' END AS encoding, bom, CASE WHEN doc_id % 5 = 0 THEN sha256(latin) ELSE sha256(text) END AS sha, 'd/' || doc_id || '.utf8.txt' AS normalized_path FROM x""")
def encoding_detect(spark, d):
    x = _contents(spark, d).withColumn("e", encoding.detect(F.col("content")))
    return x.select("doc_id", "e.encoding", "e.bom", F.sha2(encoding.decode(F.col("content"), F.col("e.encoding")), 256).alias("sha"), encoding.normalized_path(F.col("path")).alias("normalized_path"))


@query(r"""WITH x AS (SELECT doc_id % 5 = 0 AND NOT regexp_full_match(regexp_replace(text, '[^\x00-\x{FF}]', '?', 'g'), '(?s)[\x00-\x7F]*') AS odd, doc_id % 5 <> 0 AND doc_id % 3 = 0 AS bom FROM documents)
SELECT count(*) AS total_items, count(*) AS normalized, count(*) FILTER (WHERE bom) AS with_bom, count(*) FILTER (WHERE NOT odd) AS utf8_native FROM x""")
def encoding_stage_stats(spark, d):
    from folio.plans.chain import encoding_stats

    return encoding_stats(_contents(spark, d).select(encoding.detect(F.col("content")).alias("e")).select("e.*"))


# ---- pages and documents


@query(f"SELECT doc_id, 1 AS page, 'native' AS source, CASE WHEN text <> '' THEN 92.0 ELSE 0.0 END::DOUBLE AS conf, {_words('text')} AS words, length(text) AS chars FROM documents")
def page_records(spark, d):
    return readers.text_pages(_docs(spark, d)).drop("text")


@query(f"WITH {PAGES} SELECT doc_id, page, conf FROM q")
def native_confidence(spark, d):
    return _pages(spark, d).select("doc_id", "page", "conf")


@query("""WITH m AS (SELECT a.conv_id, a.turn, trim(a.text) AS n, trim(b.text) AS o, 50.0 + a.turn AS nc, 60.0 + b.conv_id % 30 AS oc, a.text AS nt, b.text AS ot FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, CASE WHEN length(n) = 0 THEN ot WHEN length(o) = 0 THEN nt WHEN length(o) > length(n) * 1.25 THEN ot ELSE nt END AS text,
CASE WHEN length(n) = 0 THEN oc WHEN length(o) = 0 THEN nc WHEN length(o) > length(n) * 1.25 OR length(n) > length(o) * 1.25 THEN greatest(nc, oc) ELSE least(99.0, greatest(nc, oc, (nc + oc) / 2)) END::DOUBLE AS conf FROM m""")
def text_merge(spark, d):
    c = table(spark, d, "conversations")
    a, b = c.select("conv_id", "turn", F.col("text").alias("n"), (50.0 + F.col("turn")).alias("nc")), c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("o"), (60.0 + F.col("conv_id") % 30).alias("oc"))
    m = a.join(b, ["conv_id", "turn"]).withColumn("m", readers.merge_texts(F.col("n"), F.col("o"), F.col("nc").cast("double"), F.col("oc").cast("double")))
    return m.select("conv_id", "turn", "m.text", "m.conf")


@query(f"""WITH {PAGES}, x AS (SELECT *, (doc_id * 7 + page * 31) % 101 / 100.0::DOUBLE AS area, (doc_id + page) % 3 AS images, ['native', 'ocr', 'mixed'][1 + doc_id % 3] AS mode FROM q),
y AS (SELECT *, images > 0 AND area >= 0.35 AND (trim(text) = '' OR conf < 85) AS over, conf <> 0 AND words <> 0 AND ((blocks >= 3 AND conf >= 70 AND area < 0.6) OR (conf >= 85 AND words > 40)) AS fine FROM x)
SELECT doc_id, page, mode, CASE WHEN mode = 'ocr' THEN 'ocr' WHEN mode = 'native' AND trim(text) = '' THEN 'ocr' WHEN mode = 'mixed' AND NOT fine THEN 'ocr' WHEN over THEN 'native+ocr' ELSE 'native' END AS decision FROM y""")
def page_decision(spark, d):
    p = K.Profile(overlay=True)
    x = _pages(spark, d).withColumns({"area": ((F.col("doc_id") * 7 + F.col("page") * 31) % 101) / 100.0, "images": (F.col("doc_id") + F.col("page")) % 3, "mode": F.get(F.array(*map(F.lit, ("native", "ocr", "mixed"))), (F.col("doc_id") % 3).cast("int"))})
    c = F.col
    return x.select("doc_id", "page", "mode", readers.page_decision(c("mode"), c("text"), c("conf"), c("words"), F.size(T.lines(c("text"))), c("area"), c("images"), p).alias("decision"))


@query("""WITH c AS (SELECT conv_id AS doc_id, max(turn)::INT + 3 AS n FROM conversations GROUP BY conv_id), s AS (SELECT doc_id, unnest(range(1, n + 1))::INT AS page FROM c),
x AS (SELECT conv_id AS doc_id, (turn + 1)::INT AS page, length(text) AS chars FROM conversations)
SELECT s.doc_id, s.page, coalesce(x.chars, 0) AS chars, x.chars IS NULL AS absent, coalesce(t.cells, 0)::BIGINT AS cells FROM s LEFT JOIN x USING (doc_id, page) LEFT JOIN (SELECT doc_id, page, (chars % 7) * 2 AS cells FROM x WHERE chars % 5 = 0) t USING (doc_id, page)""")
def page_spine(spark, d):
    p = _pages(spark, d)
    count = p.groupBy("doc_id").agg((F.max("page") + 2).alias("n"))
    rows = F.array_repeat(F.array_repeat(F.lit("x"), 2), (F.col("chars") % 7).cast("int"))
    cells = layout.cells_per_page(p.where("chars % 5 = 0").select("doc_id", "page", rows.alias("rows")))
    s = readers.on_spine(p.select("doc_id", "page", "chars"), count, cells)
    return s.select("doc_id", "page", F.coalesce("chars", F.lit(0)).alias("chars"), F.col("chars").isNull().alias("absent"), F.coalesce(F.col("cells").cast("long"), F.lit(0)).alias("cells"))


_LOW = "(conf < 70 OR (source = 'ocr' AND conf < 80))"


@query(f"WITH {PAGES} SELECT doc_id, page, array_to_string(list_filter([CASE WHEN {_LOW} THEN 'low_conf_page' END, CASE WHEN source = 'ocr' AND (words < 10 OR chars < 200) THEN 'low_text_page' END, CASE WHEN (doc_id + page) % 11 = 0 THEN 'table_extract_error' END], lambda f: f IS NOT NULL), ',') AS flags FROM q")
def page_flags(spark, d):
    c = F.col
    return _pages(spark, d).select("doc_id", "page", F.array_join(readers.page_flags(c("source"), c("conf"), c("words"), c("chars"), (c("doc_id") + c("page")) % 11 == 0), ",").alias("flags"))


@query(f"""WITH {PAGES} SELECT doc_id, page, CASE source WHEN 'ocr' THEN 'ocr' ELSE 'text' END AS source, chars, hint AS lang, locale, CASE WHEN source = 'ocr' THEN conf ELSE 0 END::DOUBLE AS ocr_conf, words,
array_to_string(list_filter([CASE WHEN source = 'ocr' AND conf < 70 THEN 'low_conf_page' END, CASE WHEN source = 'ocr' AND conf >= 70 AND words < 10 THEN 'low_text_page' END, CASE WHEN source <> 'ocr' AND chars < 200 THEN 'suspicious_text_page' END], lambda f: f IS NOT NULL), ',') AS flags,
round(chars / (595.0::DOUBLE * 842.0::DOUBLE), 6) AS text_density FROM q""")
def page_statistics(spark, d):
    return readers.page_stats(_pages(spark, d)).withColumn("flags", F.array_join("flags", ","))


SUMMARY = f"""s AS (SELECT doc_id, count(*) AS page_count, sum(words)::BIGINT AS words, sum(chars)::BIGINT AS chars, coalesce(avg(conf) FILTER (WHERE conf > 0), 0)::DOUBLE AS avg_conf, coalesce(avg(conf) FILTER (WHERE source = 'ocr'), 0)::DOUBLE AS avg_ocr_conf,
  bool_or(source = 'ocr') AS has_ocr, CASE count(DISTINCT nullif(hint, 'unknown')) WHEN 0 THEN 'unknown' WHEN 1 THEN max(nullif(hint, 'unknown')) ELSE 'mixed' END AS lang_hint,
  coalesce(arg_min(locale, page) FILTER (WHERE locale NOT IN ('unknown', 'mixed')), 'unknown') AS locale, string_agg(source, ',' ORDER BY page) AS decisions, count(*) FILTER (WHERE {_LOW}) AS low_pages FROM q GROUP BY doc_id)"""


@query(f"WITH {PAGES}, {SUMMARY} SELECT doc_id, page_count, words, chars, round(avg_conf, 6) AS avg_conf, round(avg_ocr_conf, 6) AS avg_ocr_conf, has_ocr, lang_hint, locale, decisions, low_pages, low_pages / page_count::DOUBLE >= 0.15 AS needs_review FROM s")
def document_summary(spark, d):
    s = readers.document_summary(_pages(spark, d))
    return s.withColumns({"decisions": F.array_join("decisions", ","), "avg_conf": F.round("avg_conf", 6), "avg_ocr_conf": F.round("avg_ocr_conf", 6)})


@query(f"""WITH {PAGES}, t AS (SELECT doc_id, unnest(CASE hint WHEN 'mixed' THEN ['de', 'en'] WHEN 'unknown' THEN [] ELSE [hint] END) AS tag FROM q), g AS (SELECT doc_id, count(DISTINCT tag) AS n, max(tag) AS tag FROM t GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN n = 1 THEN tag WHEN n = 2 THEN 'de+en' ELSE 'de' END AS lang FROM (SELECT DISTINCT doc_id FROM q) d LEFT JOIN g USING (doc_id)""")
def document_language(spark, d):
    return readers.document_language(_pages(spark, d))


_TAGS = r"""CASE hint WHEN 'de' THEN ['de'] WHEN 'en' THEN ['en'] WHEN 'mixed' THEN ['de', 'en'] ELSE list_filter([CASE WHEN len(list_filter(w, lambda x: NOT regexp_full_match(x, '[\x00-\x7F]*'))) > 0 THEN 'de' END,
  CASE WHEN len(list_filter(w, lambda x: regexp_full_match(x, '[\x00-\x7F]*'))) > 0 THEN 'en' END], lambda t: t IS NOT NULL) END"""


@query(rf"""WITH {PAGES}, b AS (SELECT doc_id, page, unnest({_lines('text')}) AS line FROM p), h AS (SELECT doc_id, page, length(line) AS chars, regexp_extract_all(line, '[\p{{L}}\p{{Nd}}_]+') AS w, {_hint(_tokens('line'))} AS hint FROM b),
k AS (SELECT doc_id, page, chars, {_TAGS} AS tags FROM h)
SELECT doc_id, page, round(sum(CASE WHEN list_contains(tags, 'de') THEN chars / len(tags) ELSE 0 END) / sum(chars), 4) AS de, round(sum(CASE WHEN list_contains(tags, 'en') THEN chars / len(tags) ELSE 0 END) / sum(chars), 4) AS en FROM k WHERE len(tags) > 0 GROUP BY doc_id, page""")
def language_share(spark, d):
    return readers.language_share(_pages(spark, d).select("doc_id", "page", F.explode(T.lines(F.col("text"))).alias("text")))


@query(f"""WITH {PAGES}, {SUMMARY}, b AS (SELECT doc_id, page, unnest({_lines('text')}) AS line, unnest(range(len({_lines('text')}))) AS i FROM p),
h AS (SELECT doc_id, string_agg(line, '|' ORDER BY page, i) AS headings FROM b WHERE {_heading('line')} GROUP BY doc_id)
SELECT s.doc_id, s.page_count, s.lang_hint, g.pages, h.headings FROM s JOIN (SELECT doc_id, string_agg(page || ':' || chars || ':' || hint, ',' ORDER BY page) AS pages FROM q GROUP BY doc_id) g USING (doc_id) LEFT JOIN h USING (doc_id)""")
def document_meta(spark, d):
    p = _pages(spark, d)
    m = readers.document_meta(p, readers.line_blocks(p))
    said = F.array_join(F.transform("pages", lambda x: F.concat_ws(":", x["page"], x["chars"], x["lang"])), ",")
    return m.select("doc_id", "page_count", "lang_hint", said.alias("pages"), F.array_join("headings", "|").alias("headings"))


@query(f"WITH {PAGES}, {SUMMARY} SELECT count(*) AS documents, round(avg(avg_conf), 6) AS avg_conf, sum(page_count)::BIGINT AS pages, count(*) FILTER (WHERE low_pages / page_count::DOUBLE >= 0.15) AS to_review FROM s")
def readers_stage_stats(spark, d):
    return readers.stage_stats(readers.document_summary(_pages(spark, d))).withColumn("avg_conf", F.round("avg_conf", 6))


@query("SELECT conv_id AS doc_id, sha256(string_agg(text, chr(10) ORDER BY turn)) AS sha FROM conversations GROUP BY conv_id")
def unified_text(spark, d):
    return files.unified_text(_pages(spark, d)).select("doc_id", F.sha2("text", 256).alias("sha"))


# ---- layout


def _boxes(spark, d):
    return boxes(table(spark, d, "conversations"))


@query(f"""WITH {BOXES}, g AS (SELECT doc_id, page, max(width) AS w, max(height) AS h, CASE WHEN bool_or(bbox[4] <= height * 0.12) THEN [min(bbox[1]) FILTER (WHERE bbox[4] <= height * 0.12), min(bbox[2]) FILTER (WHERE bbox[4] <= height * 0.12), max(bbox[3]) FILTER (WHERE bbox[4] <= height * 0.12), max(bbox[4]) FILTER (WHERE bbox[4] <= height * 0.12)] END AS header,
CASE WHEN bool_or(bbox[2] >= height - height * 0.12) THEN [min(bbox[1]) FILTER (WHERE bbox[2] >= height - height * 0.12), min(bbox[2]) FILTER (WHERE bbox[2] >= height - height * 0.12), max(bbox[3]) FILTER (WHERE bbox[2] >= height - height * 0.12), max(bbox[4]) FILTER (WHERE bbox[2] >= height - height * 0.12)] END AS footer FROM boxes GROUP BY doc_id, page),
z AS (SELECT doc_id, page, 'header' AS type, header AS bbox FROM g UNION ALL SELECT doc_id, page, 'footer', footer FROM g UNION ALL SELECT doc_id, page, 'body', CASE WHEN coalesce(footer[2], h) <= coalesce(header[4], 0) THEN [0, 0, w, h] ELSE [0, coalesce(header[4], 0), w, coalesce(footer[2], h)] END FROM g)
SELECT doc_id, page, type, bbox::DOUBLE[] AS bbox FROM z WHERE bbox IS NOT NULL""")
def zones(spark, d):
    return layout.zones(_boxes(spark, d))


@query(f"""WITH {BOXES} SELECT doc_id, page, block, [bbox[1], height - bbox[4], bbox[3], height - bbox[2]] AS flipped, bbox[4] - bbox[2] AS line_height, CASE WHEN least(greatest((bbox[1] + bbox[3]) / 2 / width, 0), 1) >= 0.55 THEN 1 ELSE 0 END AS column_index,
trunc(greatest(0, (bbox[1] - 10) / greatest(width * 0.04, 12)))::INT AS indent_level, CASE WHEN height - bbox[2] >= height * 0.9 THEN 'header' WHEN height - bbox[4] <= height * 0.1 THEN 'footer' ELSE 'paragraph' END AS block_type FROM boxes""")
def block_geometry(spark, d):
    b, x = F.col("flipped"), _boxes(spark, d).withColumn("flipped", geometry.flip(F.col("bbox"), F.col("height")))
    return x.select("doc_id", "page", "block", "flipped", geometry.line_height(b).alias("line_height"), geometry.column_index(b, F.col("width")).alias("column_index"), geometry.indent_level(b, F.col("width")).alias("indent_level"), geometry.block_type(F.lit(False), F.lit(False), b, F.col("height")).alias("block_type"))


_CAND = "cand AS (SELECT conv_id AS doc_id, floor(turn / 4)::INT + 1 AS page, [(conv_id * 3 % 300)::DOUBLE, (turn * 211 % 800)::DOUBLE, (conv_id * 3 % 300 + 90)::DOUBLE, (turn * 211 % 800 + 40)::DOUBLE] AS bbox FROM conversations)"


def _candidates(spark, d):
    return table(spark, d, "conversations").selectExpr(
        "conv_id as doc_id", "cast(floor(turn / 4) as int) + 1 as page", "array(cast(conv_id * 3 % 300 as double), cast(turn * 211 % 800 as double), cast(conv_id * 3 % 300 + 90 as double), cast(turn * 211 % 800 + 40 as double)) as bbox"
    )


@query(f"WITH {BOXES}, {_CAND} SELECT doc_id, page, bbox FROM cand c WHERE EXISTS (SELECT 1 FROM boxes b WHERE b.doc_id = c.doc_id AND b.page = c.page AND c.bbox[3] > b.bbox[1] AND b.bbox[3] > c.bbox[1] AND c.bbox[4] > b.bbox[2] AND b.bbox[4] > c.bbox[2])")
def overlapping_candidates(spark, d):
    return layout.overlapping(_candidates(spark, d), _boxes(spark, d))


@query(f"WITH {BOXES}, w AS (SELECT doc_id, page, block, list_transform(bbox, lambda v: v + CASE WHEN doc_id % 3 = 0 THEN 0.5 ELSE 0 END) AS bbox FROM boxes) SELECT doc_id, page, block FROM w WHERE doc_id % 3 = 0")
def words_off_blocks(spark, d):
    b = _boxes(spark, d)
    w = b.select("doc_id", "page", "block", F.transform("bbox", lambda v: v + F.when(F.col("doc_id") % 3 == 0, 0.5).otherwise(0.0)).alias("bbox"))
    return layout.words_off_blocks(w, b).select("doc_id", "page", "block")


_PROFILE = "p AS (SELECT user_id % 5 AS line, user_id // 20 * 50 + user_id % 20 AS i, count(*) FILTER (WHERE event_type = 'error')::DOUBLE AS value FROM events GROUP BY user_id)"


@query(f"""WITH {_PROFILE}, h AS (SELECT * FROM (SELECT *, greatest(5.0, floor(max(value) OVER (PARTITION BY line) * 0.1)) AS t FROM p) WHERE value > t), n AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY line ORDER BY i) <= 10 THEN 0 ELSE 1 END AS fresh FROM h),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY line ORDER BY i) AS island FROM n) SELECT line, floor(avg(i))::INT AS centre, count(*) AS places FROM g GROUP BY line, island""")
def projection_peaks(spark, d):
    e = table(spark, d, "events")
    p = e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").cast("double").alias("value")).select((F.col("user_id") % 5).alias("line"), F.expr("user_id div 20 * 50 + user_id % 20").alias("i"), "value")
    return layout.peaks(p, 10).select("line", "centre", "places")


@query("""WITH RECURSIVE o AS (SELECT conv_id, v, row_number() OVER (PARTITION BY conv_id ORDER BY v) AS r FROM (SELECT conv_id, (turn * 37 % 23)::INT AS v FROM conversations)),
k AS (SELECT conv_id, v, r, v AS last, true AS kept FROM o WHERE r = 1 UNION ALL SELECT o.conv_id, o.v, o.r, CASE WHEN o.v - k.last > 2 THEN o.v ELSE k.last END, o.v - k.last > 2 FROM k JOIN o ON o.conv_id = k.conv_id AND o.r = k.r + 1)
SELECT conv_id, string_agg(v, ',' ORDER BY v) AS lines FROM k WHERE kept GROUP BY conv_id""")
def line_dedup(spark, d):
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list((F.col("turn") * 37 % 23).cast("int")).alias("v"))
    return g.select("conv_id", F.array_join(layout.dedup_lines(F.col("v")), ",").alias("lines"))


@query(f"WITH {BOXES} SELECT doc_id, page, least(sum(greatest(bbox[3] - bbox[1], 0) * greatest(bbox[4] - bbox[2], 0)) / (600.0::DOUBLE * 850.0), 1.5) AS coverage, bool_or(height - bbox[2] >= height - height * 0.12 OR height - bbox[4] <= height * 0.12) AS header_footer FROM boxes GROUP BY doc_id, page")
def page_coverage(spark, d):
    g = _boxes(spark, d).groupBy("doc_id", "page").agg(F.sort_array(F.collect_list("bbox")).alias("b"), F.max("height").alias("h"))
    return g.select("doc_id", "page", geometry.coverage(F.col("b"), F.lit(600.0), F.lit(850.0)).alias("coverage"), layout.has_header_footer(F.transform("b", lambda x: geometry.flip(x, F.col("h"))), F.col("h")).alias("header_footer"))


@query("""WITH a AS (SELECT conv_id AS doc_id, ((turn * 53 + conv_id) % 41 - 20) / 4.0::DOUBLE AS angle FROM conversations), q AS (SELECT doc_id, quantile_cont(angle, 0.25) AS lo, quantile_cont(angle, 0.75) AS hi FROM a GROUP BY doc_id),
m AS (SELECT doc_id, least(15, greatest(-15, median(angle))) AS m FROM a JOIN q USING (doc_id) WHERE angle BETWEEN lo - (hi - lo) * 1.5 AND hi + (hi - lo) * 1.5 GROUP BY doc_id) SELECT doc_id, CASE WHEN abs(m) < 0.5 THEN 0 ELSE m END::DOUBLE AS skew FROM m""")
def page_skew(spark, d):
    return layout.skew_of(table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), (((F.col("turn") * 53 + F.col("conv_id")) % 41 - 20) / 4.0).cast("double").alias("angle")))


# ---- logs


def _logs(spark, d):
    return log_records(table(spark, d, "events"))


@query(f"WITH {LOGS} SELECT event_id, level, code, phase, run_id FROM logs WHERE level = 'ERROR' AND code = 'VL-E003' AND phase = 'phase_03'")
def log_filter(spark, d):
    return logs.query(_logs(spark, d), level="error", code="VL-E003", phase="phase_03").select("event_id", "level", "code", "phase", "run_id")


@query(f"WITH {LOGS} SELECT code, count(*) AS n FROM logs WHERE code LIKE 'VL-%' GROUP BY code")
def code_histogram(spark, d):
    return logs.code_histogram(_logs(spark, d))


@query(f"WITH {LOGS}, q AS (SELECT count(*) AS total, count(*) FILTER (WHERE run_id <> '' AND phase <> '') AS with_context, count(*) FILTER (WHERE level IN ('WARNING', 'ERROR') AND code IS NULL) AS without_code FROM logs) SELECT *, with_context / total >= 0.9 AND without_code = 0 AS passed FROM q")
def log_quality(spark, d):
    return logs.quality(_logs(spark, d))


@query(f"WITH {LOGS} SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY level, logger ORDER BY ts, event_id) AS i FROM logs) WHERE i % 10 = 0")
def log_sampling(spark, d):
    return logs.every_nth(_logs(spark, d), 10, ["ts", "event_id"], ["level", "logger"]).select("event_id")


def _seconds():
    return (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).cast("double")


_ORDERED = f"{LOGS}, o AS (SELECT event_id, level, logger, message, epoch_us(ts) / 1e6::DOUBLE AS t, row_number() OVER (PARTITION BY {{keys}} ORDER BY ts, event_id) AS r FROM logs)"


@query(f"""WITH RECURSIVE {_ORDERED.format(keys='logger, level, message')}, k AS (SELECT *, t AS last, true AS kept FROM o WHERE r = 1
UNION ALL SELECT o.*, CASE WHEN o.t - k.last >= 3600 THEN o.t ELSE k.last END, o.t - k.last >= 3600 FROM k JOIN o ON o.logger = k.logger AND o.level = k.level AND o.message = k.message AND o.r = k.r + 1) SELECT event_id FROM k WHERE kept""")
def log_repeats(spark, d):
    return logs.drop_repeats(_logs(spark, d).select("event_id", "ts", "level", "logger", "message"), 3600, ["logger", "level", "message"], _seconds(), ["ts", "event_id"]).select("event_id")


@query(f"""WITH RECURSIVE {_ORDERED.format(keys='logger')}, k AS (SELECT *, t AS start, 1 AS n FROM o WHERE r = 1
UNION ALL SELECT o.*, CASE WHEN o.t - k.start > 7200 THEN o.t ELSE k.start END, CASE WHEN o.t - k.start > 7200 THEN 1 ELSE k.n + 1 END FROM k JOIN o ON o.logger = k.logger AND o.r = k.r + 1) SELECT event_id FROM k WHERE n <= 2""")
def log_rate_limit(spark, d):
    return logs.limit_rate(_logs(spark, d).select("event_id", "ts", "logger"), 7200, 2, ["logger"], _seconds(), ["ts", "event_id"]).select("event_id")


@query(f"WITH {LOGS} SELECT run_id, arg_max(event_id, ts) AS path FROM logs GROUP BY run_id")
def latest_record(spark, d):
    return logs.latest(_logs(spark, d), "ts", "event_id", ["run_id"])


@query(f"WITH {LOGS} SELECT event_id, sha256('pepper' || user_id) AS user_id, run_id, coalesce(phase, 'none') AS phase, 'host' AS hostname FROM logs")
def log_redaction(spark, d):
    r = logs.redacted(logs.with_context(_logs(spark, d).select("event_id", "user_id", "run_id", "phase"), {"phase": "none", "hostname": "host"}), "pepper")
    return r


@query(f"WITH {LOGS} SELECT logger, count(*) AS n FROM logs WHERE regexp_full_match(logger, '(?i)USER[1-3]') GROUP BY logger")
def log_matchers(spark, d):
    return _logs(spark, d).where(logs.matches(F.col("logger"), "USER[1-3]", insensitive=True)).groupBy("logger").agg(F.count(F.lit(1)).alias("n"))


# ---- metrics


def _events(spark, d):
    return table(spark, d, "events")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) / 3600.0::DOUBLE AS rate FROM events GROUP BY ALL")
def event_rate(spark, d):
    return metrics.event_rate(_events(spark, d), "1 hour", 3600, ["event_type"])


@query("""WITH c AS (SELECT user_id, ts, (event_id % 50)::DOUBLE AS value FROM events), l AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM c)
SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, user_id, sum(CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END)::DOUBLE AS increase FROM l GROUP BY ALL""")
def counter_increase(spark, d):
    return metrics.counter_increase(_events(spark, d).select("user_id", "ts", (F.col("event_id") % 50).cast("double").alias("value")), ["user_id"], "1 day")


@query("WITH a AS (SELECT user_id, count(*)::DOUBLE AS value FROM events WHERE event_type = 'error' GROUP BY 1), b AS (SELECT user_id, count(*)::DOUBLE AS value FROM events GROUP BY 1) SELECT user_id, a.value / b.value AS ratio FROM a JOIN b USING (user_id)")
def error_ratio(spark, d):
    n = lambda e: e.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return metrics.ratio(n(_events(spark, d).where("event_type = 'error'")), n(_events(spark, d)), ["user_id"])


_BOUNDS = K.BUCKETS["api_ms"]
_HIST = f"h AS (SELECT event_type, le, count(*) FILTER (WHERE value <= le) AS n FROM events, (VALUES {', '.join(f'({b}::DOUBLE)' for b in _BOUNDS)}, ('inf'::DOUBLE)) v(le) GROUP BY event_type, le)"


@query(f"WITH {_HIST} SELECT event_type, le::VARCHAR AS le, n FROM h WHERE le < 1e9")
def histogram(spark, d):
    h = metrics.histogram(_events(spark, d), _BOUNDS, ["event_type"])
    return h.where("le < 1e9").select("event_type", F.col("le").cast("string").alias("le"), "n")


def _quantile(q: float) -> str:
    return f"""WITH {_HIST}, w AS (SELECT *, max(n) OVER (PARTITION BY event_type) AS total, coalesce(lag(le) OVER (PARTITION BY event_type ORDER BY le), 0) AS lo, coalesce(lag(n) OVER (PARTITION BY event_type ORDER BY le), 0) AS below FROM h)
SELECT event_type, arg_min(CASE WHEN isinf(le) THEN lo ELSE lo + (le - lo) * ({q}::DOUBLE * total - below) / (n - below) END, le) AS quantile FROM w WHERE n >= {q}::DOUBLE * total GROUP BY event_type"""


@query(_quantile(0.95))
def quantile_p95(spark, d):
    return metrics.quantile(metrics.histogram(_events(spark, d), _BOUNDS, ["event_type"]), 0.95, ["event_type"])


@query(_quantile(0.99))
def quantile_p99(spark, d):
    return metrics.quantile(metrics.histogram(_events(spark, d), _BOUNDS, ["event_type"]), 0.99, ["event_type"])


@query("SELECT event_type, 20.0::DOUBLE AS quantile FROM events GROUP BY event_type HAVING count(*) FILTER (WHERE value <= 20) < 0.99 * count(*)")
def quantile_saturates(spark, d):
    return metrics.quantile(metrics.histogram(_events(spark, d), (5, 10, 20), ["event_type"]), 0.99, ["event_type"])


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type, round(avg(value), 6) AS average FROM events GROUP BY ALL")
def average_over_time(spark, d):
    return metrics.average_over(_events(spark, d), "6 hours", ["event_type"]).withColumn("average", F.round("average", 6))


_SHARE = "s AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) FILTER (WHERE event_type = 'error') / count(*)::DOUBLE AS share FROM events GROUP BY 1)"


@query(f"WITH {_SHARE} SELECT start, share / 0.02 AS burn FROM s")
def burn_rate(spark, d):
    return metrics.burn_rate(_events(spark, d), "1 hour", F.col("event_type") == "error")


@query(f"""WITH {_SHARE}, x AS (SELECT start, CASE WHEN start - lag(start) OVER (ORDER BY start) <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh FROM s WHERE share > 0.2), i AS (SELECT start, sum(fresh) OVER (ORDER BY start) AS island FROM x)
SELECT 'errors' AS alert, min(start) AS begins, max(start) AS ends, count(*) AS evaluations FROM i GROUP BY island HAVING max(start) - min(start) >= INTERVAL 3 HOUR""")
def alert_stretches(spark, d):
    s = metrics.failure_share(_events(spark, d), "1 hour", F.col("event_type") == "error").withColumn("alert", F.lit("errors"))
    return metrics.alerts(s, F.col("share") > 0.2, 3 * 3600, 3600, ["alert"])


@query("SELECT user_id, sum(value)::DECIMAL(18, 2)::VARCHAR AS total FROM (SELECT user_id, value::DECIMAL(18, 2) AS value FROM events) GROUP BY user_id ORDER BY sum(value) DESC, user_id LIMIT 5")
def top_users(spark, d):
    g = _events(spark, d).groupBy("user_id").agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("t"))
    return metrics.top(g, 5, "t", ["user_id"]).select("user_id", F.col("t").cast("decimal(18,2)").cast("string").alias("total"))


@query("SELECT event_type, user_id, n FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS r FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL)) WHERE r <= 5")
def top_users_by_type(spark, d):
    g = _events(spark, d).groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return metrics.top(g, 5, "n", ["user_id"], ["event_type"])


@query("SELECT DISTINCT event_type FROM events")
def label_values(spark, d):
    return metrics.label_values(_events(spark, d), "event_type")


@query("SELECT user_id, max(value) AS value FROM events WHERE event_type = 'purchase' AND value > 50 GROUP BY 1 UNION ALL SELECT user_id, max(value) FROM events WHERE event_type = 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 50) GROUP BY 1")
def either_series(spark, d):
    m = lambda cond: _events(spark, d).where(cond).groupBy("user_id").agg(F.max("value").alias("value"))
    return metrics.either(m("event_type = 'purchase' and value > 50"), m("event_type = 'error'"), ["user_id"])


@query("SELECT user_id, CASE WHEN s > 0.3 THEN 'critical' WHEN s > 0.2 THEN 'warn' ELSE 'ok' END AS band, unnest(CASE WHEN s > 0.3 THEN ['pager', 'mail'] WHEN s > 0.2 THEN ['mail'] ELSE ['log'] END) AS receiver FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') / count(*)::DOUBLE AS s FROM events GROUP BY user_id)")
def alert_routing(spark, d):
    g = _events(spark, d).groupBy("user_id").agg((F.count_if(F.col("event_type") == "error") / F.count(F.lit(1))).alias("s"))
    b = g.select("user_id", metrics.bands(F.col("s"), 0.2, 0.3).alias("severity"))
    return metrics.routed(b, {"critical": ("pager", "mail"), "warn": ("mail",)}, "log").select("user_id", F.col("severity").alias("band"), "receiver")


# ---- contracts

_ITEM = {
    "type": "object", "required": ["event_id", "user_id", "props"], "additionalProperties": False,
    "properties": {"event_id": {"type": "integer", "minimum": 100}, "user_id": {"type": "integer", "maximum": 140}, "event_type": {"enum": ["view", "click", "error"]}, "value": {"type": "number", "minimum": 0.05}, "props": {"type": "string", "minLength": 9}},
}
_BAD = {"minimum": "(event_id < 100)::INT + (value < 0.05)::INT", "maximum": "(user_id > 140)::INT", "enum": "(event_type NOT IN ('view', 'click', 'error'))::INT", "minLength": "(length(props) < 9)::INT", "additionalProperties": "1"}


def _checked(spark, d):
    return contracts.validate(_events(spark, d), _ITEM)


@query("WITH v AS (" + " UNION ALL ".join(f"SELECT event_id, '{k}' AS validator, {v} AS n FROM events" for k, v in _BAD.items()) + ") SELECT validator, sum(n)::BIGINT AS n FROM v GROUP BY validator HAVING sum(n) > 0")
def contract_violations(spark, d):
    return _checked(spark, d).select(F.explode("violations").alias("v")).groupBy(F.col("v.validator").alias("validator")).agg(F.count(F.lit(1)).alias("n"))


@query("WITH v AS (SELECT event_id, " + " + ".join(v for k, v in _BAD.items() if k not in ("additionalProperties", "enum")) + " AS errors, 1 + (event_type NOT IN ('view', 'click', 'error'))::INT AS warnings FROM events) SELECT event_id, errors, warnings, CASE WHEN errors = 0 THEN 'ok' ELSE 'VL-E001' END AS code FROM v")
def contract_demotion(spark, d):
    e, w = contracts.demote(F.col("violations"), ("additionalProperties",), ("/properties/event_type",))
    x = _checked(spark, d).select("event_id", e.alias("e"), w.alias("w"))
    return x.select("event_id", F.size("e").alias("errors"), F.size("w").alias("warnings"), contracts.outcome(F.col("e")).alias("code"))


@query("SELECT strftime(ts, '%Y%m%d') AS run_id, count(*) + (day(ts) % 7 = 0)::INT AS total, count(*) AS n, CASE WHEN day(ts) % 7 = 0 THEN 'VL-E010' ELSE 'ok' END AS code FROM events GROUP BY strftime(ts, '%Y%m%d'), day(ts)")
def counts_agree(spark, d):
    items = _events(spark, d).select(F.date_format("ts", "yyyyMMdd").alias("run_id"), F.dayofmonth("ts").alias("day"))
    stats = items.groupBy("run_id", "day").agg(F.count(F.lit(1)).alias("n")).select("run_id", (F.col("n") + (F.col("day") % 7 == 0).cast("int")).alias("total_items"))
    return contracts.counts_agree(stats, items)


@query("SELECT count(*) AS checks, count(*) FILTER (WHERE event_id < 100) AS fails, count(*) FILTER (WHERE event_id < 100) / count(*) <= 0.05 AS passed FROM events")
def validation_report(spark, d):
    return contracts.report(_events(spark, d).select((F.col("event_id") >= 100).alias("ok")), 0.05)


# ---- values, rules and shipping



@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') AS rfc, strftime(ts, '%Y%m%dT%H%M%S') || '-' || left(md5(event_id::VARCHAR), 8) AS run_id FROM events")
def date_formats(spark, d):
    t = F.col("ts")
    return _events(spark, d).select("event_id", values.iso_utc(t).alias("iso"), values.rfc1123(t).alias("rfc"), values.run_id(t, F.col("event_id")).alias("run_id"))


@query("""SELECT event_id AS k, string_agg(name || '=' || v::VARCHAR, ',' ORDER BY name) AS timings FROM (
  SELECT event_id, unnest(['ocr_ms', 'table_extract_ms', 'text_extract_ms', 'total_ms', 'write_ms']) AS name, unnest([(event_id % 7)::DOUBLE, 0, 0, CASE WHEN event_id % 2 = 0 THEN 8.5 ELSE 4.25 END, 1.5]) AS v FROM events) GROUP BY event_id""")
def timing_merge(spark, d):
    e = _events(spark, d)
    own = F.create_map(F.lit("total_ms"), F.lit(4.25), F.lit("write_ms"), F.lit(1.5), F.lit("junk"), F.lit(9.0), F.lit("text_extract_ms"), F.lit(-1.0))
    over = F.create_map(F.lit("ocr_ms"), (F.col("event_id") % 7).cast("double"), F.lit("total_ms"), F.when(F.col("event_id") % 2 == 0, 8.5).otherwise(-1.0))
    said = F.transform(F.map_entries(values.merged_timings(own.cast("map<string,double>"), over)), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string")))
    return e.select(F.col("event_id").alias("k"), F.array_join(said, ",").alias("timings"))


RULES = "('txt', 'encoding', 'native'), ('docx', 'encoding', 'native'), ('pdf_text', 'readers', 'native'), ('image', 'readers', 'ocr')"


@query(f"WITH {TYPED} SELECT k.path, k.file_type, coalesce(r.stage, 'skip') AS stage, r.mode FROM k LEFT JOIN (VALUES {RULES}) r(file_type, stage, mode) ON r.file_type = k.file_type WHERE NOT regexp_matches(k.path, '\\.utf8(\\.|$)')")
def routing_rules(spark, d):
    rules = numbers(spark, RULES, "file_type, stage, mode")
    k = _paths(spark, d).where(~F.col("path").rlike(r"\.utf8(\.|$)")).select("path", detect.file_type(F.col("path"))["file_type"].alias("file_type"))
    return k.join(rules, "file_type", "left").select("path", "file_type", F.coalesce("stage", F.lit("skip")).alias("stage"), "mode")


@query(f"WITH {TYPED} SELECT path FROM k WHERE ext IN ('.txt', '.md', '.pdf')")
def supported_formats(spark, d):
    return _paths(spark, d).where(detect.supported(F.col("path"), ["txt", ".md", "PDF"])).select("path")


@query("SELECT event_type AS level, count(*) AS lines, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS k FROM events WHERE event_type IN ('error', 'view') GROUP BY event_type")
def shipped_lines(spark, d):
    line = F.to_json(F.struct(F.col("event_type").alias("level"), F.col("props").alias("message"), F.lit(None).cast("string").alias("trace_id")))
    parsed = _events(spark, d).select(F.from_json(line, "level string, message string, trace_id string").alias("x")).where("x.level in ('error', 'view')")
    k = F.from_json("x.message", "k long")["k"]
    return parsed.groupBy(F.col("x.level").alias("level")).agg(F.count(F.lit(1)).alias("lines"), F.sum(k).alias("k"))


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN (length(text) % 900 BETWEEN 1 AND 600 AND (conv_id * 997 % 20000) >= 9000) ELSE length(text) % 40 >= 12 END AS stays FROM conversations")
def table_filter(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    detected = layout.admissible("detect", F.col("n") % 900, F.col("conv_id") * 997 % 20000, F.lit(0))
    read = layout.admissible("extract", F.lit(0), F.lit(0), F.col("n") % 40)
    return c.select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, detected).otherwise(read).alias("stays"))


@query("SELECT user_id, CASE WHEN n > 100 THEN 350 WHEN n < 60 THEN 400 WHEN n < 76 THEN 350 ELSE 300 END AS dpi FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)")
def ocr_resolution(spark, d):
    n = _events(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    fonts = F.when(F.col("n") > 100, F.array().cast("array<double>")).otherwise(F.array(F.lit(20.0), F.col("n") / 8.0, F.lit(1.0)))
    return n.select("user_id", detect.ocr_dpi(F.lit("auto"), F.lit(0), fonts).alias("dpi"))
