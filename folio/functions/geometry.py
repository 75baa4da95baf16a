"""Boxes [x0, y0, x1, y1] as array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.constants import Profile
from folio.functions.text import case


def is_valid(b: Column) -> Column:
    return F.coalesce((F.size(b) == 4) & (b[2] > b[0]) & (b[3] > b[1]), F.lit(False))


def equal(a: Column, b: Column, tolerance: float = 1e-6) -> Column:
    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) < tolerance), lambda x: x)


def intersect(a: Column, b: Column) -> Column:
    """Boxes that only touch do not intersect."""
    return (a[2] > b[0]) & (b[2] > a[0]) & (a[3] > b[1]) & (b[3] > a[1])


def flip(b: Column, height: Column) -> Column:
    """From a top-left to a bottom-left origin, and back."""
    return F.array(b[0], height - b[3], b[2], height - b[1])


def area(b: Column) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0.0)) * F.greatest(b[3] - b[1], F.lit(0.0))


def rounded(b: Column, digits: int = 3) -> Column:
    return F.transform(b, lambda x: F.round(x, digits))


def four(values: Column) -> Column:
    """Four doubles of an array of strings or numbers: what cannot be read goes, zeros are added."""
    read = F.filter(F.transform(values, lambda v: v.try_cast("double")), lambda v: v.isNotNull())
    return F.slice(F.concat(read, F.array_repeat(F.lit(0.0), 4)), 1, 4)


def rotation(degrees: Column) -> Column:
    """0, 90, 180 or 270."""
    return F.pmod(F.bround(degrees / 90) * 90, F.lit(360.0)).cast("int")


def line_height(b: Column) -> Column:
    return F.when(is_valid(b), b[3] - b[1]).otherwise(F.lit(0.0))


def column_index(b: Column, page_width: Column, p: Profile = Profile()) -> Column:
    middle = F.least(F.greatest((b[0] + b[2]) / 2 / page_width, F.lit(0.0)), F.lit(1.0))
    return F.when(is_valid(b) & (page_width > 0) & (middle >= p.right_column), 1).otherwise(0)


def indent_level(b: Column, page_width: Column) -> Column:
    unit = F.greatest(page_width * 0.04, F.lit(12.0))
    return F.when(is_valid(b) & (page_width > 0), F.greatest(F.lit(0.0), (b[0] - 10) / unit).cast("int")).otherwise(0)


def block_type(heading: Column, is_list: Column, b: Column, page_height: Column) -> Column:
    """header and footer by a tenth of the page (bottom-left origin), else by the text."""
    placed = is_valid(b) & (page_height > 0)
    return case((placed & (b[3] >= page_height * 0.9), "header"), (placed & (b[1] <= page_height * 0.1), "footer"), (heading, "heading"), (is_list, "list_item"), default="paragraph")


def coverage(boxes: Column, width: Column, height: Column, most: float = 1.5) -> Column:
    """The boxes' area to the page's, at most `most`."""
    total = F.aggregate(boxes, F.lit(0.0), lambda a, b: a + area(b))
    return F.when(width * height > 0, F.least(total / (width * height), F.lit(most))).otherwise(F.lit(0.0))


def visual_artifact(b: Column, width: Column, height: Column) -> Column:
    """struct(kind, confidence): signature, stamp or logo by shape and place; null if none fits."""
    w, h = b[2] - b[0], b[3] - b[1]
    share, aspect = w * h / F.greatest(width * height, F.lit(1.0)), w / h
    middle = (b[1] + b[3]) / 2 / F.greatest(height, F.lit(1.0))
    said = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.least(F.lit(1.0), c).alias("confidence"))
    return F.when(
        (w > 0) & (h > 0) & (share >= 5e-4),
        case(
            ((middle > 0.6) & (aspect >= 2.5) & (share < 0.1), said("signature", 0.55 + F.least((aspect - 2.5) * 0.1, F.lit(0.4)))),
            (aspect.between(0.5, 1.5) & share.between(0.003, 0.1), said("stamp", 0.6 + (0.1 - F.abs(aspect - 1.0)) * 1.2)),
            ((middle < 0.25) & (share <= 0.15), said("logo", 0.6 + (0.15 - share) * 1.5)),
        ),
    )
