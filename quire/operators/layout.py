"""From recognised words and boxes to lines, blocks and elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.geometry import box, intersection_area

CONTAINED = 0.7
CONFIDENCE_SCALE = 100.0


def valid_words(words: DataFrame) -> DataFrame:
    """Words with text and a confidence that isn't negative."""
    return words.where((F.trim("text") != "") & (F.col("confidence") >= 0))


def _union_box() -> Column:
    left, top = F.min("bbox.x"), F.min("bbox.y")
    return box(left, top, F.max(F.expr("bbox.x + bbox.w")) - left, F.max(F.expr("bbox.y + bbox.h")) - top)


def words_to_blocks(words: DataFrame) -> DataFrame:
    """(doc_id, page, block, bbox): a block for each first part of line_key."""
    block = F.col("line_key")[0].alias("block")
    return valid_words(words).groupBy("doc_id", "page", block).agg(_union_box().alias("bbox"))


def words_to_lines(words: DataFrame) -> DataFrame:
    """(doc_id, page, box_id, line_key, text, confidence, bbox): words joined in input order, mean confidence from 0 to 1."""
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda w: w["text"]), " ")
    mean = (F.avg("confidence") / CONFIDENCE_SCALE).alias("confidence")
    return valid_words(words).groupBy("doc_id", "page", "box_id", "line_key").agg(said.alias("text"), mean, _union_box().alias("bbox"))


def lines_to_elements(lines: DataFrame) -> DataFrame:
    """(doc_id, page, box_id, text, rec_score): lines joined by newlines, the mean of line means."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_key", "text"))), lambda w: w["text"]), "\n")
    return lines.groupBy("doc_id", "page", "box_id").agg(text.alias("text"), F.avg("confidence").alias("rec_score"))


def drop_text_in_tables(boxes: DataFrame, limit: float = CONTAINED) -> DataFrame:
    """boxes (doc_id, page, pos, category, bbox) without text that lies in one table by `limit` of its area or more.

    An anti-join on the page with the overlap as its condition; a text box without area stays.
    """
    tables = boxes.where("category = 'table'").select(F.col("doc_id").alias("t_doc"), F.col("page").alias("t_page"), F.col("bbox").alias("t_box"))
    text = boxes.where("category <> 'table'")
    area = F.col("bbox.w").cast("long") * F.col("bbox.h")
    inside = (area > 0) & (intersection_area(F.col("bbox"), F.col("t_box")) >= area * F.lit(limit))
    kept = text.join(tables, (F.col("doc_id") == F.col("t_doc")) & (F.col("page") == F.col("t_page")) & inside, "left_anti")
    return boxes.where("category = 'table'").unionByName(kept)


def detection_order(detections: DataFrame) -> DataFrame:
    """(doc_id, page, text): detections joined by newlines, by the y and x of their first point."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("polygon")[0]["y"].alias("y"), F.col("polygon")[0]["x"].alias("x"), "pos", "text")))
    return detections.groupBy("doc_id", "page").agg(F.array_join(F.transform(ordered, lambda d: d["text"]), "\n").alias("text"))
