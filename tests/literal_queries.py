"""Functions on odd literals, each with its SQL; the registered queries apply the same functions to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from folio import constants as K
from folio.functions import detect, encoding, geometry, values
from folio.functions import text as T
from folio.operators import contracts, detection, layout, logs, metrics, readers
from folio.plans.views import BOXES, LOGS, boxes, log_records, numbers, table
from folio.sources import files

NUMBERS = "('3'), ('3.7'), ('x'), (''), ('-12'), ('1e3')"
QUERIES, ORACLE = {}, {}


def query(oracle):
    def keep(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, oracle
        return f

    return keep


MARKERS = "('- a'), ('* b'), ('+c'), ('1. x'), ('1)x'), ('12. x'), ('a) y'), ('b.'), ('  2. z'), (''), ('é. w')"


@query(rf"SELECT text, CASE WHEN regexp_matches(ltrim(text), '^[-*+] ') THEN substr(ltrim(text), 1, 1) WHEN regexp_matches(ltrim(text), '(?s)^[\p{{Nd}}\p{{L}}][.)].') THEN substr(ltrim(text), 1, 2) ELSE '' END AS marker FROM (VALUES {MARKERS}) t(text)")
def numbering_marker(spark, d):
    return numbers(spark, MARKERS, "text").select("text", T.numbering_marker(F.col("text")).alias("marker"))


TAGS = "('de,en'), ('GER'), ('eng+deu'), ('mixed'), ('fr'), (''), ('en, en'), ('unknown')"


@query(f"""WITH v AS (SELECT tags, list_transform(string_split(replace(tags, ',', '+'), '+'), lambda x: CASE WHEN trim(lower(x)) IN ('de', 'ger', 'deu') THEN 'de' WHEN trim(lower(x)) IN ('en', 'eng') THEN 'en' ELSE trim(lower(x)) END) AS p FROM (VALUES {TAGS}) t(tags)),
f AS (SELECT tags, list_distinct(flatten(list_transform(p, lambda x: CASE WHEN x = 'mixed' THEN ['de', 'en'] WHEN x IN ('de', 'en') THEN [x] ELSE [] END))) AS l FROM v)
SELECT tags, CASE len(l) WHEN 0 THEN 'de' WHEN 1 THEN l[1] ELSE 'de+en' END AS lang, CASE WHEN len(l) = 2 THEN 0.7 ELSE 0.95 END::DOUBLE AS conf FROM f""")
def language_tokens(spark, d):
    x = numbers(spark, TAGS, "tags").select("tags", T.collapse_tokens(T.language_tokens(F.col("tags"))).alias("lang"))
    return x.select("tags", "lang", T.language_confidence(F.col("lang")).cast("double").alias("conf"))


@query("SELECT a.h AS a, b.h AS b, CASE WHEN a.h = 'unknown' THEN b.h WHEN b.h = 'unknown' THEN a.h WHEN a.h = b.h THEN a.h ELSE 'mixed' END AS merged FROM (VALUES ('de'), ('en'), ('unknown'), ('mixed')) a(h), (VALUES ('de'), ('en'), ('unknown'), ('mixed')) b(h)")
def merge_hints(spark, d):
    hints = ["de", "en", "unknown", "mixed"]
    x = spark.createDataFrame([(a, b) for a in hints for b in hints], "a string, b string")
    return x.select("a", "b", T.merge_hints(F.col("a"), F.col("b")).alias("merged"))


ITEMS = "(1, 'a', NULL, NULL), (2, '', 'b', 'c'), (3, NULL, '', 'd'), (4, NULL, NULL, NULL), (5, '', '', '')"


@query(f"SELECT id, coalesce(nullif(p, ''), nullif(f, ''), nullif(s, '')) AS path, CASE WHEN coalesce(nullif(p, ''), nullif(f, ''), nullif(s, '')) IS NULL THEN 'missing_path' END AS reason FROM (VALUES {ITEMS}) t(id, p, f, s)")
def path_or_skipped(spark, d):
    items = numbers(spark, ITEMS, "id, path, file_path, source_path")
    named, skipped = files.paths(items)
    return named.select("id", "path", F.lit(None).cast("string").alias("reason")).unionByName(skipped.select("id", "path", "reason"))


PARAMS = "(1, NULL, 'native', 'mixed', 'pdf_text', 0.5, 'full', 200), (2, 'ocr', 'native', 'mixed', 'pdf_text', 0.9, 'light', NULL), (3, NULL, NULL, 'native', 'txt', 0.2, 'detect', 300), (4, NULL, NULL, NULL, 'image', 1.0, 'off', NULL)"


@query(f"SELECT id, lower(CASE WHEN starts_with(kind, 'pdf') AND c < 0.7 THEN 'mixed' ELSE coalesce(o, d, f, 'mixed') END) AS mode, CASE tm WHEN 'light' THEN 'detect' WHEN 'full' THEN 'extract' ELSE tm END AS tables_mode, coalesce(dpi, 300) AS dpi FROM (VALUES {PARAMS}) t(id, o, d, f, kind, c, tm, dpi)")
def parameters(spark, d):
    x = numbers(spark, PARAMS, "id, o, d, f, kind, c, tm, dpi")
    c = F.col
    return x.select("id", detect.mode(c("o").cast("string"), c("d").cast("string"), c("f").cast("string"), c("kind"), c("c").cast("double")).alias("mode"), detect.tables_mode(c("tm")).alias("tables_mode"), detect.parameter(c("dpi"), F.lit(None), F.lit(300)).alias("dpi"))


TABLES = "('ok', 3, 4, 40, 2, 1, 'pdf'), ('fallback', 2, 2, 4, 0, 0, 'ocr'), ('detect', 1, 1, 1, 0, 0, 'pdf'), ('failed', 0, 0, 0, 0, 0, ''), ('inadmissible', 5, 5, 900, 4, 4, 'pdf'), (NULL, 0, 3, 3, 0, 2, 'ocr')"


@query(f"""SELECT status, rows, cols, least(1, greatest(0, CASE lower(coalesce(status, 'failed')) WHEN 'ok' THEN 0.85 WHEN 'fallback' THEN 0.6 WHEN 'detect' THEN 0.6 WHEN 'inadmissible' THEN 0.1 ELSE 0.2 END + 0.25::DOUBLE * least(cells / 200.0::DOUBLE, 1) + CASE WHEN rows >= 2 AND cols >= 2 THEN 0.25 WHEN rows >= 1 AND cols >= 1 THEN 0.1 ELSE 0 END))::DOUBLE AS confidence,
coalesce(nullif(array_to_string(list_filter([CASE WHEN h > 0 OR v > 0 THEN 'rulings' END, CASE WHEN cols >= 3 THEN 'columns' END, CASE WHEN rows >= 2 AND cols >= 2 THEN 'grid' END], lambda x: x IS NOT NULL), ','), ''), 'layout') AS cues,
CASE WHEN tool = 'ocr' THEN 'text-alignment' WHEN h > 0 OR v > 0 THEN 'morph' ELSE 'text-alignment' END AS method FROM (VALUES {TABLES}) t(status, rows, cols, cells, h, v, tool)""")
def table_candidates(spark, d):
    c, x = F.col, numbers(spark, TABLES, "status, rows, cols, cells, h, v, tool")
    return x.select("status", "rows", "cols", layout.table_confidence(c("status"), c("rows"), c("cols"), c("cells")).cast("double").alias("confidence"), F.array_join(layout.table_cues(c("rows"), c("cols"), c("h"), c("v")), ",").alias("cues"), layout.table_method(c("h"), c("v"), c("tool")).alias("method"))


ARTIFACTS = "(1, 10.0, 700.0, 210.0, 740.0), (2, 100.0, 100.0, 200.0, 200.0), (3, 10.0, 10.0, 300.0, 60.0), (4, 0.0, 0.0, 5.0, 5.0), (5, 10.0, 400.0, 500.0, 450.0), (6, 50.0, 50.0, 40.0, 90.0)"


@query(f"""WITH v AS (SELECT id, x1 - x0 AS w, y1 - y0 AS h, (x1 - x0) * (y1 - y0) / 505750.0 AS r, (y0 + y1) / 2 / 850.0 AS cy FROM (SELECT id, x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1 FROM (VALUES {ARTIFACTS}) t(id, x0, y0, x1, y1)))
SELECT id, CASE WHEN w <= 0 OR h <= 0 OR r < 5e-4 THEN NULL WHEN cy > 0.6 AND w / h >= 2.5 AND r < 0.1 THEN 'signature' WHEN w / h BETWEEN 0.5 AND 1.5 AND r BETWEEN 0.003 AND 0.1 THEN 'stamp' WHEN cy < 0.25 AND r <= 0.15 THEN 'logo' END AS kind FROM v""")
def visual_artifacts(spark, d):
    x = numbers(spark, ARTIFACTS, "id, x0, y0, x1, y1").select("id", F.array(*[F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")]).alias("b"))
    return x.select("id", geometry.visual_artifact(F.col("b"), F.lit(595.0), F.lit(850.0))["kind"].alias("kind"))


GRID = "(1, 2, 3), (2, 1, 4), (3, 3, 3), (4, 0, 2)"


@query(f"""WITH g AS (SELECT id, r, c FROM (VALUES {GRID}) t(id, r, c)), i AS (SELECT id, c, unnest(range(r)) AS i FROM g), j AS (SELECT id, i, unnest(range(c)) AS j FROM i)
SELECT id, i::INT AS row, j::INT AS col, [j * 10.0, i * 20.0, (j + 1) * 10.0, (i + 1) * 20.0]::DOUBLE[] AS bbox FROM j""")
def grid_cells(spark, d):
    x = numbers(spark, GRID, "id, r, c").select("id", F.transform(F.sequence(F.lit(0), F.col("r")), lambda i: i * 20.0).cast("array<double>").alias("rows"), F.transform(F.sequence(F.lit(0), F.col("c")), lambda i: i * 10.0).cast("array<double>").alias("cols"))
    return x.select("id", F.explode(layout.grid_cells(F.col("rows"), F.col("cols"))).alias("x")).select("id", "x.row", "x.col", "x.bbox")


_OLD = {"required": ["a", "b"], "properties": {"a": {"type": "string"}, "b": {"type": ["string", "null"]}, "c": {"type": "integer"}, "d": {"enum": ["x", "y"]}}}
_NEW = {"required": ["a", "e"], "properties": {"a": {"type": ["string", "null"]}, "b": {"type": "string"}, "d": {"enum": ["x"]}, "e": {"type": "integer"}}}


@query("SELECT * FROM (VALUES ('b', 'required_removed'), ('b', 'type_narrowed'), ('c', 'property_removed'), ('d', 'enum_shrunk'), ('e', 'required_added')) t(property, kind)")
def contract_diff(spark, d):
    return contracts.compare(contracts.properties(spark, "old", _OLD), contracts.properties(spark, "new", _NEW))


@query("SELECT 5::BIGINT AS breaks, true AS ok")
def contract_compatible(spark, d):
    return contracts.compatible(contract_diff(spark, d), "1.4.2", "2.0.0")


MIGRATIONS = "(1, 1), (2, 2), (3, 5), (4, 4), (5, 4), (6, 9)"


@query(f"SELECT position, number, before FROM (SELECT *, lag(number) OVER (ORDER BY position) AS before FROM (VALUES {MIGRATIONS}) t(position, number)) WHERE number <= before")
def migration_order(spark, d):
    return contracts.numbering_faults(numbers(spark, MIGRATIONS, "position, number")).select("position", "number", "before")


VERSIONS = "('v1.2.10'), ('v1.10.0'), ('v1.9.9'), ('v2.0.0'), ('v1.10.1'), ('nightly')"


@query(f"SELECT arg_max(tag, list_transform(string_split(substr(tag, 2), '.'), lambda x: x::INT)) AS tag FROM (VALUES {VERSIONS}) t(tag) WHERE tag LIKE 'v%' AND list_transform(string_split(substr(tag, 2), '.'), lambda x: x::INT) < [1, 10, 1]")
def version_below(spark, d):
    return contracts.version_below(numbers(spark, VERSIONS, "tag"), "v1.10.1")


@query("SELECT * FROM (VALUES ('1.2.3', 'major', '2.0.0'), ('1.2.3', 'minor', '1.3.0'), ('1.2.3', 'patch', '1.2.4')) t(version, kind, bumped)")
def version_bump(spark, d):
    x = numbers(spark, "('1.2.3', 'major'), ('1.2.3', 'minor'), ('1.2.3', 'patch')", "version, kind")
    return x.select("version", "kind", T.bump(F.col("version"), F.col("kind")).alias("bumped"))


@query(f"SELECT v, coalesce(CASE WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN try_cast(v AS INTEGER) END, 0) AS i, coalesce(try_cast(v AS DOUBLE), 0) AS f FROM (VALUES {NUMBERS}) t(v)")
def number_defaults(spark, d):
    x = numbers(spark, NUMBERS, "v")
    return x.select("v", values.as_int(F.col("v")).alias("i"), values.as_float(F.col("v")).alias("f"))


JSONS = """('{"a": 1, "run_id": "x", "at": "2024-01-02T03:04:05Z"}'), ('{"uuid": "u", "b": "2024-01-02T03:04:05.678+01:00"}'), ('{"created_at": 5, "schema_version": "1.0.0"}'), ('{"versioning": {"schema_version": "2"}, "meta": {"version": "3"}}')"""


@query("""SELECT * FROM (VALUES ('{"a": 1, "at": "<ts>"}', NULL), ('{"b": "<ts>"}', NULL), ('{"schema_version": "1.0.0"}', '1.0.0'), ('{"versioning": {"schema_version": "2"}, "meta": {"version": "3"}}', '2')) t(masked, version)""")
def golden_mask(spark, d):
    x = numbers(spark, JSONS, "j")
    return x.select(values.without_volatile(F.col("j")).alias("masked"), values.version_marker(F.col("j")).alias("version"))


COMMITS = "('feat: a'), ('feat(x)!: b'), ('fix: c'), ('feat(core): d'), ('docs: BREAKING CHANGE e'), ('chore: f')"


@query(f"SELECT subject, CASE WHEN contains(lower(subject), 'breaking change') OR regexp_matches(lower(subject), '^[a-z]+(\\([^)]*\\))?!:') THEN 'major' WHEN regexp_matches(lower(subject), '^feat(\\([^)]*\\))?:') THEN 'minor' ELSE 'patch' END AS kind FROM (VALUES {COMMITS}) t(subject)")
def commit_rules(spark, d):
    return numbers(spark, COMMITS, "subject").select("subject", values.commit_kind(F.col("subject")).alias("kind"))
