"""Zones, tables and lines of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.constants import Profile
from folio.functions import geometry as G
from folio.functions.text import case

PROD = Profile()


def zones(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, type, bbox) from blocks (doc_id, page, bbox, width, height; origin top left): the union of the blocks in the top and bottom
    12 % as header and footer, what is between as body (the whole page if nothing is)."""
    b, h = F.col("bbox"), F.col("height")
    top, low = b[3] <= h * 0.12, b[1] >= h - h * 0.12
    union = lambda hit: F.when(F.max(hit), F.array(*[f(F.when(hit, b[i])) for i, f in enumerate((F.min, F.min, F.max, F.max))]))
    g = blocks.where(F.size(b) == 4).groupBy("doc_id", "page").agg(F.max("width").alias("w"), F.max("height").alias("h"), union(top).alias("header"), union(low).alias("footer"))
    y0, y1 = F.coalesce(F.col("header")[3], F.lit(0.0)), F.coalesce(F.col("footer")[1], F.col("h"))
    body = F.when(y1 <= y0, F.array(F.lit(0.0), F.lit(0.0), F.col("w"), F.col("h"))).otherwise(F.array(F.lit(0.0), y0, F.col("w"), y1))
    one = lambda t, box: F.struct(F.lit(t).alias("type"), box.alias("bbox"))
    z = g.select("doc_id", "page", F.explode(F.array(one("header", F.col("header")), one("footer", F.col("footer")), one("body", body))).alias("z"))
    return z.where("z.bbox is not null").select("doc_id", "page", "z.type", "z.bbox")


def has_header_footer(boxes: Column, height: Column) -> Column:
    """Whether a box (origin bottom left) reaches the top or bottom 12 %."""
    return F.exists(boxes, lambda b: (b[3] >= height - height * 0.12) | (b[1] <= height * 0.12))


def overlapping(candidates: DataFrame, blocks: DataFrame) -> DataFrame:
    """The candidates (doc_id, page, bbox) that some block of their page overlaps: a semi join on the page with a condition on boxes."""
    c, b = candidates.alias("c"), blocks.select("doc_id", "page", "bbox").alias("b")
    same = (F.col("c.doc_id") == F.col("b.doc_id")) & (F.col("c.page") == F.col("b.page"))
    return c.join(b, same & G.intersect(F.col("c.bbox"), F.col("b.bbox")), "left_semi")


def words_off_blocks(words: DataFrame, blocks: DataFrame) -> DataFrame:
    """The words (doc_id, page, block, bbox) that are not just their block again: an anti join with equal boxes."""
    w, b = words.alias("w"), blocks.select("doc_id", "page", "block", "bbox").alias("b")
    same = (F.col("w.doc_id") == F.col("b.doc_id")) & (F.col("w.page") == F.col("b.page")) & (F.col("w.block") == F.col("b.block"))
    return w.join(b, same & G.equal(F.col("w.bbox"), F.col("b.bbox")), "left_anti")


def table_confidence(status: Column, rows: Column, cols: Column, cells: Column, p: Profile = PROD) -> Column:
    """0 to 1: by status, cells and structure."""
    s = F.lower(F.coalesce(status, F.lit("failed")))
    least = lambda v: max(v, p.table_min_conf)
    base = case((s == "ok", least(0.85)), (s == "fallback", least(0.6)), (s.isin("detect", "candidate"), least(0.5)), (s == "inadmissible", 0.1), default=0.2)
    shape = case(((rows >= 2) & (cols >= 2), 0.25), ((rows >= 1) & (cols >= 1), 0.1), default=0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), base + 0.25 * F.least(cells / 200.0, F.lit(1.0)) + shape))


def table_cues(rows: Column, cols: Column, lines_h: Column, lines_v: Column) -> Column:
    cues = F.array_compact(F.array(F.when((lines_h > 0) | (lines_v > 0), "rulings"), F.when(cols >= 3, "columns"), F.when((rows >= 2) & (cols >= 2), "grid")))
    return F.when(F.size(cues) == 0, F.array(F.lit("layout"))).otherwise(cues)


def table_method(lines_h: Column, lines_v: Column, tool: Column, morph: bool = True, alignment: bool = True) -> Column:
    t = F.lower(F.coalesce(tool, F.lit("")))
    if not morph and not alignment:
        return F.when(t != "", t).otherwise(F.lit("unknown"))
    ruled = (lines_h > 0) | (lines_v > 0)
    by_lines = F.lit("morph") if not alignment else F.when(ruled & F.lit(morph), "morph").otherwise("text-alignment")
    return F.when((t == "ocr") & F.lit(alignment), "text-alignment").otherwise(by_lines)


def admissible(mode: str, cells: Column, mean_area: Column, words: Column, p: Profile = PROD) -> Column:
    """Whether a table stays: by its cells when only detected, by its words when read."""
    return (cells > 0) & (cells <= p.table_max_cells) & (mean_area >= p.table_min_area) if mode == "detect" else words >= p.table_min_words


def cells_per_page(tables: DataFrame) -> DataFrame:
    """(doc_id, page, cells) of tables (doc_id, page, rows array<array<string>>)."""
    return tables.groupBy("doc_id", "page").agg(F.sum(F.aggregate("rows", F.lit(0), lambda a, r: a + F.size(r))).alias("cells"))


def peaks(profile: DataFrame, gap: int, key: str = "line") -> DataFrame:
    """Centres of the groups of places i of profile (key, i, value) whose value is above a whole-number tenth of the largest (and above 5); places at most `gap` apart are one group."""
    most = Window.partitionBy(key)
    hit = profile.withColumn("t", F.greatest(F.lit(5.0), F.floor(F.max("value").over(most) * 0.1).cast("double"))).where("value > t")
    w = Window.partitionBy(key).orderBy("i")
    island = hit.withColumn("new", (F.coalesce(F.col("i") - F.lag("i").over(w), F.lit(gap + 1)) > gap).cast("int")).withColumn("island", F.sum("new").over(w))
    return island.groupBy(key, "island").agg(F.floor(F.avg("i")).cast("int").alias("centre"), F.count(F.lit(1)).alias("places"))


def dedup_lines(positions: Column, tolerance: float = 2) -> Column:
    """Sorted positions without those within the tolerance of the last that is kept."""
    p = F.sort_array(positions)
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(p, F.slice(p, 1, 1), lambda a, x: F.when(x - last(a) > tolerance, F.concat(a, F.array(x))).otherwise(a))


def grid_cells(rows: Column, cols: Column) -> Column:
    """The boxes between neighbouring lines: array<struct(row, col, bbox)>."""
    r, c = F.size(rows) - 1, F.size(cols) - 1
    cell = lambda i: lambda j: F.struct(i.alias("row"), j.alias("col"), F.array(F.get(cols, j), F.get(rows, i), F.get(cols, j + 1), F.get(rows, i + 1)).alias("bbox"))
    all_ = F.flatten(F.transform(F.sequence(F.lit(0), r - 1), lambda i: F.transform(F.sequence(F.lit(0), c - 1), cell(i))))
    return F.when((r > 0) & (c > 0), all_)


def skew_of(lines: DataFrame, key: str = "doc_id", angle: str = "angle") -> DataFrame:
    """(key, skew): the median of the angles within 1.5 quartile ranges, held to 15 degrees; 0 under half a degree."""
    q = lines.groupBy(key).agg(F.percentile(angle, F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    x = lines.join(q, key)
    reach = (F.col("q")[1] - F.col("q")[0]) * 1.5
    m = x.where(F.col(angle).between(F.col("q")[0] - reach, F.col("q")[1] + reach)).groupBy(key).agg(F.median(angle).alias("m"))
    held = F.greatest(F.lit(-15.0), F.least(F.lit(15.0), F.col("m")))
    return m.select(key, F.when(F.abs(held) < 0.5, 0.0).otherwise(held).alias("skew"))
