"""Nested JSON documents as VARIANT rows: schemas checked keyword by keyword, references resolved by a join, payloads read in either of their forms.

A document is parsed once; what is in it is reached by exploding variants, so documents of any shape share one plan.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import values
from folio.functions.text import case

# The keywords of the schema language by what they hold.
TYPES = ("array", "boolean", "integer", "null", "number", "object", "string")
MAPS, LISTS, SINGLE = ("properties", "patternProperties", "$defs", "definitions"), ("anyOf", "allOf", "oneOf", "prefixItems"), ("items", "additionalProperties", "not", "if", "then", "else", "contains", "propertyNames")
NUMBERS, SIZES = ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"), ("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties")
TEXTS = ("$id", "$ref", "$schema", "title", "description", "format", "pattern")


def exploded(df: DataFrame, column: str, to: str) -> DataFrame:
    """df with `to`: struct(pos, key, value), a row per member of an object or item of a list in the variant column; other values have none."""
    got = df.sparkSession.tvf.variant_explode(F.col(column).outer()).select(F.struct("pos", "key", "value").alias(to))
    return df.lateralJoin(got)


def kind(v: Column) -> Column:
    """object, array, string, integer, number, boolean, null: what a variant holds."""
    s = F.schema_of_variant(v)
    whole = s.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$")
    return case(
        (s.startswith("OBJECT"), "object"), (s.startswith("ARRAY"), "array"), (s == "STRING", "string"), (whole, "integer"), (s.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number"), (s == "BOOLEAN", "boolean"), default="null"
    )


def subschemas(schemas: DataFrame, depth: int = 6) -> DataFrame:
    """(name, path, v): every schema in schemas (name, text), itself at the path '' (v null where the text is no JSON), down to `depth` levels."""
    level = schemas.select("name", F.lit("").alias("path"), F.try_parse_json("text").alias("v"))
    out = [level]
    for _ in range(depth):
        m = exploded(level, "v", "m").select("name", F.concat("path", F.lit("/"), "m.key").alias("path"), F.col("m.key").alias("word"), F.col("m.value").alias("v"))
        many = exploded(m.where(F.col("word").isin(*MAPS, *LISTS)), "v", "x")
        many = many.where(F.col("word").isin(*MAPS) == F.col("x.key").isNotNull())
        many = many.select("name", F.concat("path", F.lit("/"), F.coalesce("x.key", F.col("x.pos").cast("string"))).alias("path"), F.col("x.value").alias("v"))
        level = many.unionByName(m.where(F.col("word").isin(*SINGLE)).select("name", "path", "v"))
        out.append(level)
    return functools.reduce(DataFrame.unionByName, out)


def _fits(word: Column, v: Column, is_: Column) -> Column:
    """Whether a keyword's value is of the form it must have; unknown keywords fit."""
    names = F.try_variant_get(v, "$", "array<string>")
    plain = (is_ == "array") & F.schema_of_variant(v).isin("ARRAY<STRING>", "ARRAY<VOID>")
    unique = plain & (F.size(F.array_distinct(names)) == F.size(names))
    number = F.try_variant_get(v, "$", "double")
    known = lambda x: x.isin(*TYPES)
    return case(
        (word == "type", ((is_ == "string") & known(F.try_variant_get(v, "$", "string"))) | (unique & (F.size(names) > 0) & F.forall(names, known))), (word == "required", unique), (word == "enum", is_ == "array"),
        (word.isin(*MAPS), is_ == "object"), (word.isin(*LISTS), (is_ == "array") & (F.schema_of_variant(v) != "ARRAY<VOID>")), (word.isin(*SINGLE), is_.isin("object", "boolean")),
        (word == "multipleOf", is_.isin("integer", "number") & (number > 0)), (word.isin(*NUMBERS), is_.isin("integer", "number")), (word.isin(*SIZES), (is_ == "integer") & (number >= 0)), (word == "uniqueItems", is_ == "boolean"),
        (word.isin(*TEXTS), is_ == "string"), default=F.lit(True),
    )


def schema_faults(schemas: DataFrame, depth: int = 6) -> DataFrame:
    """(name, path, reason) of what is wrong in schemas (name, text): `not JSON`, `not a schema`, a keyword with a value of another form (`keyword`), and a $ref that leads to no schema (`unresolved`).

    A $ref is a place in its own schema (#/...), the $id of a schema, or a place in such a one (id#/...)."""
    parts = subschemas(schemas, depth).withColumn("kind", kind(F.col("v")))
    broken = parts.where("v is null").select("name", "path", F.lit("not JSON").alias("reason"))
    no_schema = parts.where("v is not null and kind not in ('object', 'boolean')").select("name", "path", F.lit("not a schema").alias("reason"))
    # A single subschema of another form is told by its keyword.
    own = F.element_at(F.split("path", "/"), -1)
    no_schema = no_schema.where(~(own.isin(*SINGLE)) | F.element_at(F.split("path", "/"), -2).isin(*MAPS))
    words = exploded(parts.where("kind = 'object'"), "v", "m").select("name", "path", F.col("m.key").alias("word"), F.col("m.value").alias("value"))
    bad = words.where(~F.coalesce(_fits(F.col("word"), F.col("value"), kind(F.col("value"))), F.lit(False)))
    bad = bad.select("name", F.concat("path", F.lit("/"), "word").alias("path"), F.lit("keyword").alias("reason"))
    text = F.try_variant_get("value", "$", "string")
    refs = words.where("word = '$ref'").select("name", "path", text.alias("ref")).where("ref is not null")
    ids = words.where("word = '$id' and path = ''").select(F.col("name").alias("owner"), text.alias("id")).where("id is not null")
    targets = parts.where("v is not null").select(F.col("name").alias("owner"), F.col("path").alias("place"))
    near = refs.where(F.col("ref").startswith("#")).select("name", "path", F.col("name").alias("owner"), F.expr("substring(ref, 2)").alias("place"))
    far = refs.where(~F.col("ref").startswith("#")).withColumns({"id": F.substring_index("ref", "#", 1), "place": F.when(F.contains("ref", F.lit("#")), F.substring_index("ref", "#", -1)).otherwise("")})
    far = far.join(ids, "id", "left").select("name", "path", "owner", "place")
    lost = near.unionByName(far).join(targets, ["owner", "place"], "left_anti")
    return broken.unionByName(no_schema).unionByName(bad).unionByName(lost.select("name", F.concat("path", F.lit("/$ref")).alias("path"), F.lit("unresolved").alias("reason")))


# The places of page geometry in a summary, and its figures.
GEOMETRY_KEYS = ("page_geometry", "page_dimensions", "page_sizes", "page_metrics")
GEOMETRY = ("width", "height", "rotation", "images_count", "graphics_objects_count")


def geometry(summaries: DataFrame) -> DataFrame:
    """(doc_id, page, GEOMETRY) of summaries (doc_id, summary: JSON text). Under each of the keys there is an object of entries by page or a list of entries with a page; a later figure replaces an
    earlier one. Pages that are no whole number over 0 are none; a figure that is no number counts as 0."""
    v = summaries.select("doc_id", F.try_parse_json("summary").alias("v"))
    places = F.array(*[F.struct(F.lit(i).alias("i"), F.try_variant_get("v", f"$.{k}", "variant").alias("of")) for i, k in enumerate(GEOMETRY_KEYS)])
    each = v.select("doc_id", F.explode(places).alias("p")).select("doc_id", "p.i", F.col("p.of").alias("of"))
    entry = exploded(each, "of", "e").where(kind(F.col("e.value")) == "object")
    page = values.as_int(F.coalesce("e.key", F.try_variant_get("e.value", "$.page", "string")))
    number = lambda g: F.when(F.try_variant_get("e.value", f"$.{g}", "string").isNotNull(), values.as_float(F.try_variant_get("e.value", f"$.{g}", "string")).cast("double"))
    rows = entry.select("doc_id", page.alias("page"), F.struct("i", F.coalesce("e.pos", F.lit(0))).alias("at"), *[number(g).alias(g) for g in GEOMETRY]).where("page > 0")
    return rows.groupBy("doc_id", "page").agg(*[F.max_by(g, F.when(F.col(g).isNotNull(), F.col("at"))).alias(g) for g in GEOMETRY])
