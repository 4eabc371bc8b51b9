"""Inputs of the registered queries, derived from the given tables; each with the same view in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.geometry import box


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BOX = "l_orderkey AS doc_id, CAST(1 + {div} AS {int}) AS page, row_number() OVER (PARTITION BY l_orderkey, {div} ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS pos, CASE WHEN l_returnflag = 'N' THEN 'table' WHEN l_partkey % 13 = 0 THEN 'title' WHEN l_partkey % 17 = 0 THEN 'page-footer' ELSE 'text' END AS category, CASE WHEN l_returnflag = 'N' THEN l_partkey % 2 * 250 ELSE l_partkey % 500 END AS x, (l_suppkey * 7 + l_partkey * 3) % 700 AS y, CASE WHEN l_returnflag = 'N' THEN 200 ELSE 20 + CAST(floor(l_quantity) AS BIGINT) * 4 END AS w, 10 + l_partkey % 40 AS h, CASE WHEN l_returnflag = 'A' THEN NULL ELSE round(1 - l_discount * 5, 4) END AS score, l_linenumber % 4 * 90 AS rotation, 1 + l_partkey % 2 AS n_cols, l_partkey AS part"
#: boxes(doc_id, page, pos, category, x, y, w, h, score, rotation, n_cols, part), for DuckDB.
BOXES = "boxes AS (SELECT " + _BOX.format(div="l_linenumber // 3", int="BIGINT") + " FROM lineitem)"
#: elements: boxes with their index in the page and their id.
ELEMENTS = BOXES + ", elements AS (SELECT *, page * 10000 + idx AS id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY y, x, pos) - 1 AS idx FROM boxes))"
#: words(doc_id, box_id, pos, text, confidence, k0, k1, x, y, w, h)
WORDS = "words AS (SELECT user_id AS doc_id, event_id % 3 AS box_id, event_id AS pos, event_type AS text, least(value, 100) AS confidence, event_id % 5 AS k0, event_id % 7 AS k1, event_id % 500 AS x, event_id % 300 AS y, 10 + event_id % 20 AS w, 12 AS h FROM events)"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box for each line of an order: the order as document, three lines to a page."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(*_split(_BOX.format(div="(l_linenumber div 3)", int="INT")))
    return rows.withColumn("bbox", box(F.col("x"), F.col("y"), F.col("w"), F.col("h")))


def _split(columns: str) -> list[str]:
    """A select list cut at its commas outside brackets."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(columns):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(columns[at:i])
            at = i + 1
    return [*out, columns[at:]]


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word for each event."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    return e.select(F.col("user_id").alias("doc_id"), F.lit(1).alias("page"), (n % 3).alias("box_id"), n.alias("pos"), F.col("event_type").alias("text"), F.least("value", F.lit(100.0)).alias("confidence"), F.array((n % 5).cast("int"), (n % 7).cast("int")).alias("line_key"), box(n % 500, n % 300, 10 + n % 20, F.lit(12)).alias("bbox"))


def spoilt(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Predictions and gold texts: the words of the documents, and the same with every 7th word missing (even ids) or every 11th twice (odd ids). German has no prediction, Spanish no gold text."""
    d = table(spark, sf_dir, "documents").withColumn("words", F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"))
    lost = F.expr("filter(words, (w, i) -> (i + 1) % 7 <> 0)")
    doubled = F.expr("flatten(transform(words, (w, i) -> if((i + 1) % 11 = 0, array(w, w), array(w))))")
    joined = lambda c: F.array_join(c, " ").alias("text")
    predicted = d.where("lang <> 'de'").select("doc_id", joined(F.when(F.col("doc_id") % 2 == 0, lost).otherwise(doubled)))
    return predicted, d.where("lang <> 'es'").select("doc_id", joined("words"))
