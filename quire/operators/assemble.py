"""Pages of boxes to documents of elements: ids, links, reading order and checks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.functions.geometry import bounding_box, corners, element_id, to_canonical

MIN_GAP = 8
EDGE_TOLERANCE = 0.02


def assign_ids(boxes: DataFrame) -> DataFrame:
    """boxes with index and id: by top, left and input position within a page."""
    by = Window.partitionBy("doc_id", "page").orderBy("bbox.y", "bbox.x", "pos")
    out = boxes.withColumn("index", F.row_number().over(by) - 1)
    return out.withColumn("id", element_id(F.col("page"), F.col("index")))


def content_to_canonical(elements: DataFrame) -> DataFrame:
    """elements with lines and cell_boxes in the canonical frame, from polygons and boxes of the deskewed frame and deskew_matrix."""
    m = F.col("deskew_matrix")
    line = lambda x: x.withField("polygon", to_canonical(x["polygon"], m))
    return elements.withColumns({"lines": F.transform("lines", line), "cell_boxes": F.transform("cell_boxes", lambda b: bounding_box(to_canonical(corners(b), m)))})


def link_tables(elements: DataFrame, tolerance: float = EDGE_TOLERANCE) -> DataFrame:
    """(doc_id, head, tail): the last table of a page that goes on as the first one of the next page.

    elements: doc_id, page, id, category, bbox, n_rows, n_cols; a failed table has no n_cols.
    """
    tables = elements.where("category = 'table'").select("doc_id", "page", F.struct("id", "bbox", "n_cols").alias("t"))
    ends = tables.groupBy("doc_id", "page").agg(F.max_by("t", "t.id").alias("last"), F.min_by("t", "t.id").alias("first"))
    after = Window.partitionBy("doc_id").orderBy("page")
    pairs = ends.select("doc_id", "last", F.when(F.lead("page").over(after) == F.col("page") + 1, F.lead("first").over(after)).alias("next"))
    width = F.greatest("last.bbox.w", "next.bbox.w")
    left = F.abs(F.col("last.bbox.x") - F.col("next.bbox.x"))
    right = F.abs(F.expr("last.bbox.x + last.bbox.w") - F.expr("next.bbox.x + next.bbox.w"))
    fits = (F.col("last.n_cols") == F.col("next.n_cols")) & (width > 0) & (left <= width * tolerance) & (right <= width * tolerance)
    return pairs.where(fits).select("doc_id", F.col("last.id").alias("head"), F.col("next.id").alias("tail"))


def chain_heads(links: DataFrame) -> DataFrame:
    """(doc_id, id, head): for each element that continues others, the first one of its chain.

    Chains are followed by doubling, so k rounds cover chains of 2^k pages; a cycle stops at its least member.
    """
    now, held = links.select("doc_id", F.col("tail").alias("id"), F.col("head")), None
    while True:
        up = now.select(F.col("doc_id").alias("d"), F.col("id").alias("via"), F.col("head").alias("above"))
        joined = now.join(up, (F.col("doc_id") == F.col("d")) & (F.col("head") == F.col("via")) & (F.col("above") < F.col("head")), "left")
        step = joined.select("doc_id", "id", F.coalesce("above", "head").alias("head"), F.col("above").isNotNull().alias("moved")).persist()
        done = not step.where("moved").head(1)
        if held is not None:
            held.unpersist()
        if done:
            step.unpersist()
            return now
        now, held = step.drop("moved"), step


def widest_gaps(region: np.ndarray, start: np.ndarray, size: np.ndarray, least: int = MIN_GAP) -> dict[int, int]:
    """The middle of the widest uncovered stretch of each region's projection, for regions that have one of `least` or more; the first of equals.

    Regions share one axis: each is moved beyond all others, so that one running maximum covers all projections.
    """
    stop = start + size
    far = int(max(stop.max(), start.max()) - min(start.min(), stop.min())) + 1
    order = np.lexsort((stop, start, region))
    region, start, stop = region[order], start[order], stop[order]
    covered = np.maximum.accumulate(stop + region * far)[:-1] - region[:-1] * far
    gap = np.where(region[1:] == region[:-1], start[1:] - covered, 0)
    wide = np.flatnonzero((gap >= least) & (gap > 0))
    wide = wide[np.lexsort((wide, -gap[wide], region[wide]))]
    regions, first = np.unique(region[wide], return_index=True)
    at = wide[first]
    return dict(zip(regions.tolist(), ((covered[at] + start[at + 1]) // 2).tolist(), strict=True))


def xy_cut(boxes: list[tuple[int, int, int, int]]) -> list[int]:
    """Indices of (x, y, w, h) boxes in reading order: columns first, then rows, else top and left.

    All regions of a page are cut at once, level by level: a region with an uncovered column between
    its boxes is cut there, else one with an uncovered row. Regions are numbered in reading order, so a cut
    renumbers them as pairs; the last regions are read by top and left.
    """
    if not boxes:
        return []
    at = np.array(boxes, dtype=np.int64)
    region = np.zeros(len(at), dtype=np.int64)
    while True:
        cuts: dict[int, tuple[int, int]] = {}
        for axis in (1, 0):
            cuts |= {r: (axis, c) for r, c in widest_gaps(region, at[:, axis], at[:, axis + 2]).items()}
        if not cuts:
            return np.lexsort((np.arange(len(at)), at[:, 0], at[:, 1], region)).tolist()
        later = np.zeros(len(at), dtype=np.int64)
        for r, (axis, c) in cuts.items():
            later[(region == r) & (at[:, axis] >= c)] = 1
        region = np.unique(region * 2 + later, return_inverse=True)[1].reshape(-1)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _page_order(pages: pd.Series) -> pd.Series:
    """The ids of the boxes (id, x, y, w, h) of each page in reading order; a page holds 10,000 boxes at most."""
    ordered = lambda boxes: [boxes[i]["id"] for i in xy_cut([(b["x"], b["y"], b["w"], b["h"]) for b in boxes])]
    return pages.map(ordered)


def reading_order(elements: DataFrame) -> DataFrame:
    """elements (doc_id, page, id, bbox, render, ...) with reading_order, dense from 0 over a document.

    Within a page the flow goes by XY-cut, the rest follows by its top edge.
    """
    flow = elements.where("render = 'flow'").groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("id", "bbox.x", "bbox.y", "bbox.w", "bbox.h"))).alias("page_boxes"))
    ranked = flow.select("doc_id", F.posexplode(_page_order("page_boxes")).alias("rank", "id"))
    out = elements.join(ranked, ["doc_id", "id"], "left")
    by = Window.partitionBy("doc_id").orderBy("page", F.col("rank").isNull(), "rank", "bbox.y", "id")
    return out.withColumn("reading_order", F.row_number().over(by) - 1).drop("rank")


def first_cut(elements: DataFrame, least: int = MIN_GAP) -> DataFrame:
    """(doc_id, page, cut): the widest horizontal gap of each page, as gaps and islands in windows; null without one."""
    spans = elements.select("doc_id", "page", F.col("bbox.x").alias("start"), F.expr("bbox.x + bbox.w").alias("stop"))
    before = Window.partitionBy("doc_id", "page").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    gaps = spans.withColumn("frontier", F.max("stop").over(before)).withColumn("gap", F.col("start") - F.col("frontier"))
    cut = F.struct(F.col("gap").alias("gap"), (-F.col("start")).alias("before"), F.expr("(frontier + start) div 2").alias("cut"))
    return gaps.groupBy("doc_id", "page").agg(F.max(F.when(F.col("gap") >= least, cut))["cut"].alias("cut"))


def order_errors(elements: DataFrame) -> DataFrame:
    """(doc_id, n, error): documents whose reading_order isn't 0 to n - 1, each once."""
    per = elements.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("reading_order").alias("k"), F.min("reading_order").alias("low"), F.max("reading_order").alias("high"))
    error = F.when(F.col("low") < 0, "an element has no reading order").when(F.col("k") != F.col("n"), "a reading order occurs twice").when((F.col("low") != 0) | (F.col("high") != F.col("n") - 1), "the reading order has gaps")
    return per.select("doc_id", "n", error.alias("error")).where("error is not null")


def dangling_references(elements: DataFrame, column: str) -> DataFrame:
    """(doc_id, id, target): references in caption_id or continues_from to elements that the document lacks."""
    known = elements.select(F.col("doc_id").alias("d"), F.col("id").alias("known"))
    asked = elements.where(F.col(column).isNotNull()).select("doc_id", "id", F.col(column).alias("target"))
    return asked.join(known, (F.col("doc_id") == F.col("d")) & (F.col("target") == F.col("known")), "left_anti")


def grid_coverage(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """(doc_id, id, covered, flag): cells (doc_id, id, rowspan, colspan) against tables (doc_id, id, n_rows, n_cols)."""
    covered = cells.groupBy("doc_id", "id").agg(F.sum(F.col("rowspan") * F.col("colspan")).alias("covered"))
    out = tables.join(covered, ["doc_id", "id"], "left").withColumn("covered", F.coalesce("covered", F.lit(0)))
    return out.select("doc_id", "id", "covered", F.when(F.col("covered") != F.col("n_rows") * F.col("n_cols"), "cell_count_mismatch").alias("flag"))
