"""Contracts: JSON Schema keywords compiled to predicates over columns, and comparison of contracts.

A violation is struct(path, validator, message). Everything is checked in one pass over the rows; policies then split the violations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from folio.functions import text as T

# The formats of identifiers.
RUN_ID = r"^[0-9]{8}T[0-9]{6}-[0-9a-f]{8}$"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
FORMATS = {"run-id": RUN_ID, "uuid": UUID, "path": r"^[^\x00]+$"}

VIOLATION = "array<struct<path:string,validator:string,message:string>>"
_KINDS = {
    "string": (S.StringType,), "integer": (S.IntegerType, S.LongType, S.ShortType), "number": (S.IntegerType, S.LongType, S.DoubleType, S.FloatType, S.DecimalType), "boolean": (S.BooleanType,),
    "array": (S.ArrayType,), "object": (S.StructType, S.MapType), "null": (S.NullType,),
}


def _said(path: str, validator: str, message: str) -> Column:
    return F.array(F.struct(F.lit(path).alias("path"), F.lit(validator).alias("validator"), F.lit(message).alias("message")))


def _none() -> Column:
    return F.array().cast(VIOLATION)


def violations(schema: dict, column: Column, kind: S.DataType, path: str = "", definitions: dict | None = None) -> Column:
    """The array of violations of a column of the given type. A null counts as an absent property; `definitions` resolves $ref."""
    definitions = definitions or {}
    if "$ref" in schema:
        schema = definitions[schema["$ref"]] | {k: v for k, v in schema.items() if k != "$ref"}
    found: list[Column] = []
    fail = lambda bad, validator, message: found.append(F.when(F.coalesce(bad, F.lit(False)), _said(path, validator, message)).otherwise(_none()))
    wanted = schema.get("type")
    wanted = [wanted] if isinstance(wanted, str) else wanted
    if wanted and not any(isinstance(kind, _KINDS[w]) for w in wanted if w != "null"):
        fail(column.isNotNull(), "type", f"{kind.simpleString()} is not {' or '.join(wanted)}")
    if "const" in schema:
        fail(column != F.lit(schema["const"]), "const", f"not {schema['const']}")
    if "enum" in schema:
        fail(~column.isin(list(schema["enum"])), "enum", "not one of the values")
    if isinstance(kind, S.StringType):
        if "minLength" in schema:
            fail(F.length(column) < schema["minLength"], "minLength", f"shorter than {schema['minLength']}")
        if schema.get("format") in FORMATS:
            fail(~column.rlike(FORMATS[schema["format"]]), "format", f"not a {schema['format']}")
    if isinstance(kind, _KINDS["number"]):
        for word, bad in (("minimum", lambda v: column < v), ("maximum", lambda v: column > v)):
            if word in schema:
                fail(bad(schema[word]), word, f"beyond {schema[word]}")
    if isinstance(kind, S.ArrayType):
        for word, bad in (("minItems", lambda v: F.size(column) < v), ("maxItems", lambda v: F.size(column) > v)):
            if word in schema:
                fail(column.isNotNull() & bad(schema[word]), word, f"against {schema[word]} items")
        if "items" in schema:
            each = F.flatten(F.transform(column, lambda x: violations(schema["items"], x, kind.elementType, f"{path}/items", definitions)))
            found.append(F.coalesce(each, _none()))
    if isinstance(kind, S.MapType) and "minProperties" in schema:
        fail(F.size(column) < schema["minProperties"], "minProperties", f"under {schema['minProperties']} properties")
    if isinstance(kind, S.StructType):
        names = {f.name: f for f in kind.fields}
        for r in schema.get("required", ()):
            fail(column.isNotNull() & (column[r].isNull() if r in names else F.lit(True)), "required", f"{r} is missing")
        for name, part in schema.get("properties", {}).items():
            if name in names:
                found.append(F.coalesce(F.when(column.isNotNull(), violations(part, column[name], names[name].dataType, f"{path}/properties/{name}", definitions)), _none()))
        if schema.get("additionalProperties") is False:
            for name in sorted(set(names) - set(schema.get("properties", {}))):
                fail(column.isNotNull() & column[name].isNotNull(), "additionalProperties", f"{name} is not allowed")
    if "anyOf" in schema:
        ok = reduce(Column.__or__, [F.size(violations(s, column, kind, path, definitions)) == 0 for s in schema["anyOf"]])
        fail(~ok, "anyOf", "fits none")
    return F.concat(*found) if found else _none()


def validate(df: DataFrame, schema: dict, definitions: dict | None = None) -> DataFrame:
    """df with `violations`, the row taken as one object."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.withColumn("violations", violations(schema, row, df.schema, "", definitions))


def demote(found: Column, validators: tuple[str, ...] = (), paths: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """(errors, warnings): a violation is a warning if its validator is listed or its path, with a leading slash, has a listed part."""
    soft = lambda v: v["validator"].isin(list(validators)) | reduce(Column.__or__, [F.contains(v["path"], F.lit(p)) for p in paths], F.lit(False))
    return F.filter(found, lambda v: ~soft(v)), F.filter(found, soft)


def outcome(found: Column, soft: bool = False, dry_run: bool = False, code: str = "VL-E001") -> Column:
    """ok, the warning VL-W001 if nothing is to be raised, or the error code."""
    return F.when(F.size(found) == 0, "ok").otherwise(F.lit("VL-W001") if soft or dry_run else F.lit(code))


def counts_agree(stats: DataFrame, items: DataFrame, total: str = "total_items") -> DataFrame:
    """(run_id, total, n, ok) of stage statistics (run_id, total) against the items (run_id) there are; VL-E010 where they differ."""
    n = items.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    j = stats.join(n, "run_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return j.select("run_id", F.col(total).alias("total"), "n", F.when(F.col(total) == F.col("n"), "ok").otherwise("VL-E010").alias("code"))


def version_check(found: Column, expected: Column) -> Column:
    return T.case((expected.isNull(), "no-expected"), (found.isNull(), "missing"), (found == expected, "ok"), default="mismatch")


def properties(spark: SparkSession, name: str, schema: dict) -> DataFrame:
    """One row per property of a contract: contract, property, types, enum, required."""
    kinds = lambda s: [s["type"]] if isinstance(s.get("type"), str) else list(s.get("type", ()))
    rows = [(name, p, kinds(s), [str(e) for e in s["enum"]] if "enum" in s else None, p in schema.get("required", ())) for p, s in schema.get("properties", {}).items()]
    rows += [(name, p, None, None, True) for p in schema.get("required", ()) if p not in schema.get("properties", {})]
    return spark.createDataFrame(rows, "contract string, property string, types array<string>, enum array<string>, required boolean")


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """(property, kind) of what the new properties break for those who keep to the old: a full outer join by name."""
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, F.col("o.property") == F.col("n.property"), "full_outer")
    there = lambda s: F.col(f"{s}.property").isNotNull() & F.col(f"{s}.types").isNotNull()
    lost = lambda a, b: F.size(F.array_except(a, b)) > 0
    need = lambda s: F.coalesce(F.col(f"{s}.required"), F.lit(False))
    kinds = F.array_compact(
        F.array(
            F.when(need("o") & ~need("n"), "required_removed"), F.when(need("n") & ~need("o"), "required_added"), F.when(there("o") & ~there("n"), "property_removed"),
            F.when(there("o") & there("n") & (F.size("o.types") > 0) & (F.size("n.types") > 0) & lost(F.col("o.types"), F.col("n.types")), "type_narrowed"),
            F.when(F.col("o.enum").isNotNull() & F.col("n.enum").isNotNull() & lost(F.col("o.enum"), F.col("n.enum")), "enum_shrunk"),
        )
    )
    return j.select(F.coalesce("o.property", "n.property").alias("property"), F.explode(kinds).alias("kind"))


def compare_schemas(old: DataFrame, new: DataFrame) -> DataFrame:
    """(name, kind) of what breaks at the level of whole schemas (name, additional_properties): those that are gone, and those that no longer allow further properties."""
    j = old.select("name", F.col("additional_properties").alias("o")).join(new.select("name", F.col("additional_properties").alias("n"), F.lit(True).alias("there")), "name", "left")
    kind = F.when(F.col("there").isNull(), "schema_removed").when(F.coalesce("o", F.lit(True)) & (F.col("n") == F.lit(False)), "additional_properties_disabled")
    return j.select("name", kind.alias("kind")).where("kind is not null")


def schema_of(artifacts: DataFrame, schemas: DataFrame) -> DataFrame:
    """artifacts (file) with the schema of their file name, or `minimal` where there is none."""
    found = artifacts.join(schemas.select("file", "schema"), "file", "left")
    return found.withColumn("schema", F.coalesce("schema", F.lit("minimal")))


def compatible(breaks: DataFrame, old_version: str, new_version: str) -> DataFrame:
    """One row: how many breaks, and whether they are allowed (none, or a new major version)."""
    major = T.bump_kind(F.lit(old_version), F.lit(new_version)) == "major"
    return breaks.agg(F.count(F.lit(1)).alias("breaks")).withColumn("ok", (F.col("breaks") == 0) | major)


def numbering_faults(migrations: DataFrame, block: int = 100_000) -> DataFrame:
    """The migrations (position, number) that do not exceed the one before. Positions are sorted in blocks of `block`; only the last of each block meets the others."""
    x = migrations.withColumn("__b", F.expr(f"position div {block}"))
    ends = x.groupBy("__b").agg(F.max_by("number", "position").alias("__l"))
    ends = ends.select("__b", F.lag("__l").over(Window.orderBy("__b")).alias("__e"))
    own = F.lag("number").over(Window.partitionBy("__b").orderBy("position"))
    y = x.withColumn("__own", own).join(ends, "__b").withColumn("before", F.coalesce("__own", "__e"))
    return y.where(F.col("number") <= F.col("before")).drop("__b", "__own", "__e")


def version_below(tags: DataFrame, current: str) -> DataFrame:
    """The highest version (column tag) strictly below the current one."""
    v, c = T.semver(F.col("tag")), T.semver(F.lit(current))
    return tags.where(v < c).agg(F.max_by("tag", v).alias("tag"))


def report(results: DataFrame, most_failing: float = 0.0) -> DataFrame:
    """One row of results (ok boolean): checks, failures and the gate."""
    r = results.agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("ok")).alias("fails"))
    return r.withColumn("passed", (F.col("checks") == 0) | (F.col("fails") / F.col("checks") <= most_failing))


FIRST_ERRORS = 5


def report_levels(results: DataFrame, most_failing: float = 0.0, first: int = FIRST_ERRORS) -> DataFrame:
    """(level, phase, glob, checks, fails, passed, errors): results (phase, glob, file, error: null if fine) by phase and glob, by phase, and in all; errors are the
    first `first` of the level by file, as `file: error`. The levels come from the counts of phase and glob in one rollup."""
    bad = F.col("error").isNotNull()
    counts = results.groupBy("phase", "glob").agg(F.count(F.lit(1)).alias("checks"), F.count_if(bad).alias("fails"))
    nth = F.row_number().over(Window.partitionBy("phase", "glob").orderBy("file", "error"))
    few = results.where(bad).withColumn("__n", nth).where(F.col("__n") <= first).groupBy("phase", "glob").agg(F.collect_list(F.struct("file", "error")).alias("e"))
    both = counts.alias("c").join(few.alias("f"), F.col("c.phase").eqNullSafe(F.col("f.phase")) & F.col("c.glob").eqNullSafe(F.col("f.glob")), "left").select("c.*", F.coalesce("e", F.expr("array()")).alias("e"))
    r = both.rollup("phase", "glob").agg(
        F.grouping_id().alias("g"), F.sum("checks").alias("checks"), F.sum("fails").alias("fails"), F.slice(F.array_sort(F.flatten(F.collect_list("e"))), 1, first).alias("e")
    )
    level = T.case((F.col("g") == 0, "glob"), (F.col("g") == 1, "phase"), default="all")
    errors = F.transform("e", lambda x: F.concat(x["file"].cast("string"), F.lit(": "), x["error"]))
    return r.select(level.alias("level"), "phase", "glob", "checks", "fails", ((F.col("checks") == 0) | (F.col("fails") / F.col("checks") <= most_failing)).alias("passed"), errors.alias("errors"))


def markdown(levels: DataFrame) -> DataFrame:
    """(level, phase, glob, line): the rows of report_levels() as lines of a Markdown table; bars in a cell are escaped."""
    cell = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|"))
    share = F.when(F.col("checks") > 0, F.format_string("%.2f%%", 100.0 * F.col("fails") / F.col("checks"))).otherwise("-")
    cells = [F.col("level"), cell(F.col("phase")), cell(F.col("glob")), F.col("checks").cast("string"), F.col("fails").cast("string"), share, F.when(F.col("passed"), "pass").otherwise("FAIL"), cell(F.array_join("errors", "; "))]
    return levels.select("level", "phase", "glob", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
