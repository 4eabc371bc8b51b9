"""The round trip of pages through human review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HEADER = r"^<!-- page: (\d+) lines: (\d+) -->$"


def page_lines(lines: DataFrame) -> DataFrame:
    """lines (doc_id, page, reading_order, pos, text) with line_no from 0 within a page, in reading order."""
    by = Window.partitionBy("doc_id", "page").orderBy("reading_order", "pos")
    return lines.withColumn("line_no", F.row_number().over(by) - 1)


def review_pages(lines: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(doc_id, page, name, body) of the pages that fail the gate: a header with the line count, then the lines.

    lines: doc_id, page, line_no, text; verdicts: doc_id, page, passed.
    """
    failed = verdicts.where("not passed").select("doc_id", "page")
    per = lines.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("lines"))
    out = failed.join(per, ["doc_id", "page"], "left").withColumn("lines", F.coalesce("lines", F.array().cast(per.schema["lines"].dataType)))
    head = F.format_string("<!-- page: %d lines: %d -->\n", "page", F.size("lines"))
    body = F.array_join(F.transform("lines", lambda x: F.concat(x["text"], F.lit("\n"))), "")
    return out.select("doc_id", "page", F.format_string("p%04d.md", "page").alias("name"), F.concat(head, body).alias("body"))


def parse_pages(files: DataFrame) -> DataFrame:
    """files (doc_id, path, body) as (doc_id, path, page, declared, lines, error); error says what is wrong, else null."""
    first = F.trim(F.substring_index("body", "\n", 1))
    text = F.regexp_replace("body", r"\n\z", "")
    rest = F.slice(F.split(text, "\n", -1), 2, 1 << 30)
    page, declared = (F.expr("try_cast(regexp_extract(first, '^<!-- page: ([0-9]+) lines: ([0-9]+) -->$', %d) as int)" % k) for k in (1, 2))
    out = files.withColumns({"first": first, "lines": rest}).withColumns({"page": page, "declared": declared})
    error = F.when(F.col("page").isNull(), "no review header").when(F.size("lines") != F.col("declared"), F.format_string("expected %d lines, found %d", "declared", F.size("lines")))
    return out.select("doc_id", "path", "page", "declared", "lines", error.alias("error"))


class ReviewError(ValueError):
    """Review files that can't be applied."""


def require_valid(files: DataFrame) -> DataFrame:
    """files, or an error that names the first one that doesn't parse; no files at all are an error too."""
    parsed = parse_pages(files)
    bad = parsed.where("error is not null").orderBy("doc_id", "path").head(1)
    if bad:
        raise ReviewError(f"{bad[0].path}: {bad[0].error}")
    if not files.head(1):
        raise ReviewError("no review pages")
    return files


def corrections(files: DataFrame) -> DataFrame:
    """(doc_id, page, line_no, text) of valid files (see require_valid for others); of two files for a page the later path counts."""
    good = parse_pages(files).where("error is null").groupBy("doc_id", "page").agg(F.max_by("lines", "path").alias("lines"))
    return good.select("doc_id", "page", F.posexplode("lines").alias("line_no", "text"))


def apply_corrections(lines: DataFrame, fixes: DataFrame) -> DataFrame:
    """lines (doc_id, page, line_no, text, text_ocr) with corrected text and an error for pages whose line count differs.

    Pages without corrections and pages in error keep their text; text_ocr never changes.
    """
    count = lambda df, name: df.groupBy("doc_id", "page").agg(F.count("*").alias(name))
    sizes = count(fixes, "given").join(count(lines, "expected"), ["doc_id", "page"])
    error = F.when(F.col("given") != F.col("expected"), F.format_string("expected %d lines, found %d", "expected", "given"))
    state = sizes.select("doc_id", "page", error.alias("error"))
    new = fixes.withColumnRenamed("text", "fixed")
    out = lines.join(state, ["doc_id", "page"], "left").join(new, ["doc_id", "page", "line_no"], "left")
    text = F.when(F.col("error").isNull(), F.coalesce("fixed", "text")).otherwise(F.col("text"))
    return out.select("doc_id", "page", "line_no", text.alias("text"), "text_ocr", "error")


def page_slices(texts: DataFrame) -> DataFrame:
    """texts (doc_id, text) as (doc_id, page, text) between page markers; without markers page is null and the text whole."""
    mark = r"<!--\s*page:\s*(\d+)\s*-->"
    numbers: Column = F.regexp_extract_all("text", F.lit(mark), F.lit(1))
    parts = texts.select("doc_id", "text", numbers.alias("pages"), F.split("text", mark, -1).alias("parts"))
    zipped = F.arrays_zip("pages", F.slice("parts", 2, 1 << 30).alias("body"))
    marked = parts.where(F.size("pages") > 0).select("doc_id", F.posexplode(zipped).alias("pos", "s"))
    marked = marked.groupBy("doc_id", F.col("s.pages").cast("int").alias("page")).agg(F.min_by("s.body", "pos").alias("text"))
    whole = parts.where(F.size("pages") == 0).select("doc_id", F.lit(None).cast("int").alias("page"), "text")
    return marked.unionByName(whole)
