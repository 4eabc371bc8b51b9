"""Layout, order, field and calibration metrics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.alignment import levenshtein
from quire.functions.geometry import iou

IOU_FLOOR = 0.5


@F.pandas_udf(T.LongType())
def character_errors(predicted: pd.Series, gold: pd.Series) -> pd.Series:
    """The edit distance in code points; a row of bits at a time, so long texts are cheaper than cell by cell."""
    return pd.Series([None if p is None or g is None else levenshtein(p, g) for p, g in zip(predicted, gold, strict=True)], dtype="Int64")


_MATCH = T.StructType([T.StructField("p", T.IntegerType()), T.StructField("g", T.IntegerType()), T.StructField("iou", T.DoubleType()), T.StructField("same_type", T.BooleanType())])


@F.pandas_udf(T.ArrayType(_MATCH))
def _greedy(candidates: pd.Series) -> pd.Series:
    """The candidates (iou, p, g, same_type) of a page that are taken: the largest IoU first, each box once."""

    def taken(rows) -> list[dict]:
        used, out = set(), []
        for r in sorted(rows, key=lambda r: (-r["iou"], r["p"], r["g"])):
            if used.isdisjoint(ends := {("p", r["p"]), ("g", r["g"])}):
                used |= ends
                out.append(r)
        return out

    return candidates.map(taken)


def detections(predicted: DataFrame, gold: DataFrame, floor: float = IOU_FLOOR) -> DataFrame:
    """(doc_id, page, p, g, iou, same_type): boxes (doc_id, page, pos, category, bbox) matched greedily by IoU, each once, from `floor` on.

    Boxes meet on their page; a page holds 10,000 boxes at most, and few of them overlap by half.
    """
    p = predicted.select("doc_id", "page", F.col("pos").alias("p"), F.col("category").alias("p_type"), F.col("bbox").alias("p_box"))
    g = gold.select("doc_id", "page", F.col("pos").alias("g"), F.col("category").alias("g_type"), F.col("bbox").alias("g_box"))
    both = p.join(g, ["doc_id", "page"]).withColumn("iou", iou(F.col("p_box"), F.col("g_box"))).where(F.col("iou") >= floor)
    row = F.struct(F.col("p").cast("int").alias("p"), F.col("g").cast("int").alias("g"), "iou", (F.col("p_type") == F.col("g_type")).alias("same_type"))
    per = both.groupBy("doc_id", "page").agg(F.collect_list(row).alias("rows"))
    return per.select("doc_id", "page", F.inline(_greedy("rows")))


def detection_scores(matches: DataFrame, predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: precision, recall, f1 and type_accuracy; null where there is nothing to divide by."""
    one = lambda df, name: df.agg(F.count("*").alias(name))
    m = matches.agg(F.count("*").alias("m"), F.avg(F.col("same_type").cast("int")).alias("type_accuracy"))
    n = one(predicted, "n_pred").unionByName(one(gold, "n_gold"), allowMissingColumns=True).unionByName(m, allowMissingColumns=True)
    n = n.agg(*[F.max(c).alias(c) for c in ("n_pred", "n_gold", "m", "type_accuracy")])
    precision, recall = F.try_divide("m", "n_pred"), F.try_divide("m", "n_gold")
    return n.select(precision.alias("precision"), recall.alias("recall"), F.try_divide(2 * F.col("m"), F.col("n_pred") + F.col("n_gold")).alias("f1"), "type_accuracy")


def rising_pairs(values: np.ndarray) -> int:
    """Pairs of places i < j with values[i] < values[j], by halves: a sorted left half tells how many of it are below each value of the right one."""
    if len(values) < 64:
        return int(np.triu(values[:, None] < values[None, :], 1).sum())
    half = len(values) // 2
    left, right = values[:half], values[half:]
    return rising_pairs(left) + rising_pairs(right) + int(np.searchsorted(np.sort(left), right, "left").sum())


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in ("concordant", "discordant", "pairs")]))
def _concordance(orders: pd.Series) -> pd.DataFrame:
    """Pairs with different reading_order that rise, fall, and all of them, for each array of structs (reading_order, gold_order)."""
    out = []
    for rows in orders:
        own, gold = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("reading_order", "gold_order"))
        ties = np.unique(own, return_counts=True)[1]
        pairs = len(own) * (len(own) - 1) // 2 - int((ties * (ties - 1) // 2).sum())
        out.append((rising_pairs(gold[np.lexsort((-gold, own))]), rising_pairs(-gold[np.lexsort((gold, own))]), pairs))
    return pd.DataFrame(out, columns=["concordant", "discordant", "pairs"])


def order_tau(elements: DataFrame) -> DataFrame:
    """(doc_id, concordant, pairs, tau): Kendall's tau of reading_order against gold_order; null for one element.

    A document's orders are one row of numbers, counted in n log n steps; pairs are never made.
    """
    per = elements.groupBy("doc_id").agg(F.collect_list(F.struct(*[F.col(c).cast("long").alias(c) for c in ("reading_order", "gold_order")])).alias("orders"))
    out = per.select("doc_id", _concordance("orders").alias("c")).select("doc_id", "c.*")
    return out.select("doc_id", "concordant", "pairs", F.try_divide(F.col("concordant") - F.col("discordant"), F.col("pairs")).alias("tau"))


def cer(predicted: Column, gold: Column) -> Column:
    """Character errors over gold characters; null for an empty gold text."""
    return F.try_divide(character_errors(predicted, gold), F.nullif(F.length(gold), F.lit(0)))


def field_scores(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """One row of field precision, recall, f1, null_accuracy and hallucination for (doc_id, field, value); values match exactly.

    Fields whose gold value is null count for null_accuracy (the share left null) and hallucination (the rest).
    """
    p = predicted.select("doc_id", "field", F.col("value").alias("pv"))
    g = gold.select("doc_id", "field", F.col("value").alias("gv"), F.lit(True).alias("asked"))
    both = g.join(p, ["doc_id", "field"], "full")
    right = F.count_if(F.col("pv") == F.col("gv"))
    said, true = F.count("pv"), F.count("gv")
    nulls = F.count_if(F.col("asked") & F.col("gv").isNull())
    kept = F.count_if(F.col("asked") & F.col("gv").isNull() & F.col("pv").isNull())
    return both.agg(F.try_divide(right, said).alias("precision"), F.try_divide(right, true).alias("recall"), F.try_divide(2 * right, said + true).alias("f1"), F.try_divide(kept, nulls).alias("null_accuracy"), F.try_divide(nulls - kept, nulls).alias("hallucination"))


def document_accuracy(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """(doc_id, all_right): whether every field with a gold value matches."""
    p = predicted.select("doc_id", "field", F.col("value").alias("pv"))
    both = gold.where("value is not null").join(p, ["doc_id", "field"], "left")
    return both.groupBy("doc_id").agg(F.bool_and(F.coalesce(F.col("pv") == F.col("value"), F.lit(False))).alias("all_right"))


def calibration(rows: DataFrame, bins: int = 10) -> DataFrame:
    """(bin, n, confidence, accuracy) of rows (confidence 0 to 1, correct 0 or 1)."""
    at = F.least(F.lit(bins - 1), F.floor(F.col("confidence") * bins)).cast("int")
    return rows.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.avg("confidence").alias("confidence"), F.avg("correct").alias("accuracy"))


def expected_calibration_error(bins: DataFrame) -> DataFrame:
    return bins.agg((F.sum(F.col("n") * F.abs(F.col("confidence") - F.col("accuracy"))) / F.sum("n")).alias("ece"))


def routed_fields(asked: DataFrame, branches: list[DataFrame]) -> DataFrame:
    """asked (doc_id, field) with value and branch: each branch (doc_id, field, value), cheapest first, fills only what earlier ones left open."""
    out = asked.withColumns({"value": F.lit(None).cast("string"), "branch": F.lit(None).cast("int")})
    for k, branch in enumerate(branches):
        new = branch.where("value is not null").select("doc_id", "field", F.col("value").cast("string").alias("new"))
        out = out.join(new, ["doc_id", "field"], "left")
        first = F.col("value").isNull() & F.col("new").isNotNull()
        out = out.select("doc_id", "field", F.coalesce("value", "new").alias("value"), F.when(first, F.lit(k)).otherwise(F.col("branch")).alias("branch"))
    return out
