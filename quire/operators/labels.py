"""Training labels for recognised lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.functions.alignment import labelled_lines
from quire.functions.geometry import bounding_box, from_canonical

MIN_WIDTH, MIN_HEIGHT, MIN_LINES = 16, 8, 50
VARIANTS = ("blur", "noise", "jpeg")


def text_lines(elements: DataFrame) -> DataFrame:
    """(doc_id, page, id, pos, line.*) of the lines of text elements (doc_id, page, id, category, kind, lines); other elements have none."""
    text = elements.where("category = 'text' and kind = 'text'")
    return text.select("doc_id", "page", "id", F.posexplode("lines").alias("pos", "line")).select("doc_id", "page", "id", "pos", "line.*")


def with_crops(aligned: DataFrame, crops: DataFrame) -> DataFrame:
    """Aligned lines (doc_id, page, line_no, ...) whose crop exists, by the crop's file name pNNNN_lNNNN.png; crops: doc_id, path."""
    name = F.regexp_extract("path", r"p(\d+)_l(\d+)\.png$", 1), F.regexp_extract("path", r"p(\d+)_l(\d+)\.png$", 2)
    cut = crops.select("doc_id", "path", *[n.try_cast("int").alias(c) for n, c in zip(name, ("page", "line_no"), strict=True)])
    return aligned.join(cut, ["doc_id", "page", "line_no"])


def number_lines(lines: DataFrame) -> DataFrame:
    """Lines of text elements (doc_id, page, id, pos, ...) with line_no from 0 within a page."""
    by = Window.partitionBy("doc_id", "page").orderBy("id", "pos")
    return lines.withColumn("line_no", F.row_number().over(by) - 1)


def crop_boxes(lines: DataFrame) -> DataFrame:
    """Numbered lines with a crop box in the deskewed frame, from polygon and deskew_matrix; small crops go, numbers stay."""
    out = number_lines(lines).withColumn("crop", bounding_box(from_canonical(F.col("polygon"), F.col("deskew_matrix"))))
    return out.where(f"crop.w >= {MIN_WIDTH} and crop.h >= {MIN_HEIGHT}")


_FOUND = T.StructType([T.StructField("label", T.StringType()), T.StructField("similarity", T.DoubleType()), T.StructField("reason", T.StringType())])


@F.pandas_udf(T.ArrayType(_FOUND))
def _align(pages: pd.Series, gold: pd.Series) -> pd.Series:
    made = lambda lines, text: [dict(zip(("label", "similarity", "reason"), f, strict=True)) for f in labelled_lines(list(lines), text)]
    return pd.Series([made(lines, text) for lines, text in zip(pages, gold, strict=True)], dtype=object)


def align_lines(lines: DataFrame, gold: DataFrame) -> DataFrame:
    """(doc_id, page, line_no, label, similarity, reason): labels for lines (doc_id, page, line_no, text) from gold pages (doc_id, page, text).

    Lines of pages without gold text get a reason and no label.
    """
    keys = ["doc_id", "page"]
    line = lines.select(*keys, F.struct("line_no", F.coalesce("text", F.lit("")).alias("text")).alias("line"))
    truth = gold.where("doc_id is not null and page is not null").select(*keys, F.coalesce("text", F.lit("")).alias("gold"))
    every = line.unionByName(truth, allowMissingColumns=True)
    # One exchange takes lines and gold to their page; a number of partitions that is asked for isn't merged by adaptive execution, as aligning costs more than bytes suggest.
    met = every.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    per = met.groupBy(*keys).agg(F.array_sort(F.collect_list("line")).alias("lines"), F.collect_list("gold").alias("golds")).where("size(lines) > 0")
    both = per.select(*keys, "lines", F.explode_outer("golds").alias("gold"))
    each = both.select(*keys, F.explode(F.arrays_zip("lines", _align(F.col("lines.text"), F.coalesce("gold", F.lit(""))).alias("found"))).alias("z"))
    own = [F.col(k).cast(lines.schema[k].dataType).alias(k) for k in keys]
    return each.select(*own, "z.lines.line_no", "z.found.label", "z.found.similarity", "z.found.reason")


def report(aligned: DataFrame) -> DataFrame:
    """(doc_id, written, rejected)."""
    return aligned.groupBy("doc_id").agg(F.count_if(F.col("label").isNotNull()).alias("written"), F.count_if(F.col("label").isNull()).alias("rejected"))


def skipped_documents(lines: DataFrame, gold: DataFrame) -> DataFrame:
    """(doc_id, pages, reason): documents with lines and without any gold text, which get no labels."""
    per = lines.groupBy("doc_id").agg(F.count_distinct("page").alias("pages"))
    return per.join(gold.select("doc_id").distinct(), "doc_id", "left_anti").withColumn("reason", F.lit("no ground truth"))


def rejects(aligned: DataFrame) -> DataFrame:
    """(name, reason) of the lines without a label, for the log."""
    return aligned.where("label is null").select(F.format_string("%s/p%04d_l%04d", F.col("doc_id").cast("string"), "page", "line_no").alias("name"), "reason")


def augmented(labels: DataFrame) -> DataFrame:
    """Each label once for every degradation, with a seed that makes noise repeatable."""
    out = labels.withColumn("variant", F.explode(F.array(*[F.lit(v) for v in VARIANTS])))
    return out.withColumn("seed", F.pmod(F.xxhash64("doc_id", "page", "line_no", "variant"), F.lit(2**31)))


def labelled_pairs(files: DataFrame) -> DataFrame:
    """files (path) as (stem, text_path, image_path): every .gt.txt with a .png beside it."""
    text = files.where(F.col("path").endswith(".gt.txt")).select(F.regexp_replace("path", r"\.gt\.txt$", "").alias("stem"), F.col("path").alias("text_path"))
    image = files.where(F.col("path").endswith(".png")).select(F.regexp_replace("path", r"\.png$", "").alias("stem"), F.col("path").alias("image_path"))
    return text.join(image, "stem")


def training_list(pairs: DataFrame, least: int = MIN_LINES) -> DataFrame:
    """Sorted (path) of the training files; fewer than `least` is an error."""
    n = pairs.count()
    if n < least:
        raise ValueError(f"{n} labelled lines are too few to train on; at least {least} are needed")
    return pairs.select(F.concat("stem", F.lit(".lstmf")).alias("path")).orderBy("path")
