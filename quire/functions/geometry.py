"""Boxes, points and page frames as column expressions.

A box is a struct (x, y, w, h) of ints, a point a struct (x, y) of doubles, an affine map an
array of six doubles (a, b, c, d, e, f): x' = a x + b y + c, y' = d x + e y + f.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROTATIONS = (0, 90, 180, 270)
ELEMENTS_PER_PAGE = 10_000
ASIDE_CLASSES = ("page-header", "page-footer", "footnote")


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(*[v.cast("int").alias(k) for k, v in zip("xywh", (x, y, w, h), strict=True)])


def corners(b: Column) -> Column:
    """The four corners of a box, clockwise from the top left."""
    right, bottom = b["x"] + b["w"], b["y"] + b["h"]
    return F.array(point(b["x"], b["y"]), point(right, b["y"]), point(right, bottom), point(b["x"], bottom))


def bounding_box(points: Column) -> Column:
    """The least box of whole pixels around points."""
    of = lambda k, f: f(F.transform(points, lambda p: p[k]))
    x, y = F.floor(of("x", F.array_min)), F.floor(of("y", F.array_min))
    return box(x, y, F.ceil(of("x", F.array_max)) - x, F.ceil(of("y", F.array_max)) - y)


def from_canonical(points: Column, m: Column) -> Column:
    """Points of the canonical frame in the deskewed frame."""
    return F.transform(points, lambda p: point(m[0] * p["x"] + m[1] * p["y"] + m[2], m[3] * p["x"] + m[4] * p["y"] + m[5]))


def to_canonical(points: Column, m: Column) -> Column:
    """The inverse of from_canonical; a singular map is an error."""
    det = m[0] * m[4] - m[1] * m[3]
    det = F.when(F.abs(det) < 1e-12, F.raise_error(F.lit("the deskew matrix is singular")).cast("double")).otherwise(det)
    back = lambda p: point((m[4] * (p["x"] - m[2]) - m[1] * (p["y"] - m[5])) / det, (m[0] * (p["y"] - m[5]) - m[3] * (p["x"] - m[2])) / det)
    return F.transform(points, back)


def pdf_points(b: Column, dpi: Column, rotation: Column, width_pt: Column, height_pt: Column) -> Column:
    """A canonical box in PDF points before rotation, as (x, y, w, h) of doubles; null for an image source."""
    x, y, w, h = (b[k] * 72.0 / dpi for k in "xywh")
    made = lambda *v: F.struct(*[c.cast("double").alias(k) for k, c in zip("xywh", v, strict=True)])
    turned = (
        F.when(rotation == 0, made(x, y, w, h))
        .when(rotation == 90, made(y, height_pt - x - w, h, w))
        .when(rotation == 180, made(width_pt - x - w, height_pt - y - h, w, h))
        .when(rotation == 270, made(width_pt - y - h, x, h, w))
    )
    return F.when(width_pt.isNotNull() & height_pt.isNotNull(), turned)


def unrotated_size(rotation: Column, width_pt: Column, height_pt: Column) -> Column:
    """The page's size before a quarter turn, as (width_pt, height_pt)."""
    turned = rotation.isin(90, 270)
    return F.struct(F.when(turned, height_pt).otherwise(width_pt).alias("width_pt"), F.when(turned, width_pt).otherwise(height_pt).alias("height_pt"))


def geometry_error(rotation: Column, matrix: Column, width_pt: Column, height_pt: Column) -> Column:
    """What is wrong with a page geometry; null if nothing is."""
    return (
        F.when(~rotation.isin(*ROTATIONS), "rotation_applied must be a quarter turn")
        .when(F.size(matrix) != 6, "deskew_matrix must have 6 values")
        .when(width_pt.isNull() != height_pt.isNull(), "a PDF size needs both sides")
    )


def element_id(page: Column, index: Column) -> Column:
    """page * 10000 + index; an index beyond the page's range is an error."""
    made = page.cast("long") * ELEMENTS_PER_PAGE + index
    return F.when((index < 0) | (index >= ELEMENTS_PER_PAGE), F.raise_error(F.lit("a page holds 10,000 elements")).cast("long")).otherwise(made)


def render_mode(category: Column, is_linked_caption: Column, continues_from: Column) -> Column:
    return F.when(is_linked_caption | continues_from.isNotNull(), "inlined").when(category.isin(*ASIDE_CLASSES), "aside").otherwise("flow")


def intersection_area(a: Column, b: Column) -> Column:
    across = lambda k, n: F.greatest(F.lit(0), F.least(a[k] + a[n], b[k] + b[n]) - F.greatest(a[k], b[k]))
    return across("x", "w").cast("long") * across("y", "h")


def iou(a: Column, b: Column) -> Column:
    shared = intersection_area(a, b)
    whole = a["w"].cast("long") * a["h"] + b["w"].cast("long") * b["h"] - shared
    return F.when(whole > 0, shared / whole).otherwise(F.lit(0.0))
