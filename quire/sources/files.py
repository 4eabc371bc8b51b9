"""Files as DataFrames: images and PDFs, loose texts, ground truth, snapshots and artifacts."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.geometry import geometry_error
from quire.operators.serialize import DOCUMENT_SCHEMA
from quire.operators.serialize import PAGE_SCHEMA as ARTIFACT_SCHEMA

IMAGES = ("png", "jpg", "jpeg", "tif", "tiff", "bmp", "webp")
TEXTS = ("md", "markdown", "txt", "docx")
PAGE_SCHEMA = "doc_id string, page int, content binary, width_px int, height_px int, dpi int, rotation_applied int, deskew_angle double, deskew_matrix array<double>, pdf_width_pt double, pdf_height_pt double"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


class SourceError(ValueError):
    """An input that breaks a rule of its format."""


def _paths(df: DataFrame) -> DataFrame:
    """df with stem and suffix (lower case) of its path."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return df.withColumns({"stem": F.regexp_replace(name, r"\.[^.]*$", ""), "suffix": F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))})


def binary_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modificationTime, length, content, stem, suffix) of all files below a folder."""
    return _paths(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder))


def content_hashes(files: DataFrame) -> DataFrame:
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def load_pages(files: DataFrame, render: Callable[[bytes, str, int], Iterator[dict]] | None = None, dpi: int = 300) -> DataFrame:
    """Pages of image and PDF files, PAGE_SCHEMA; other suffixes are an error.

    An image is its one page as it is. PDFs need `render(content, suffix, dpi)`, which yields a dict of the
    PAGE_SCHEMA columns for each page; it runs once for each file, in Arrow batches on the executors.
    """
    known = F.col("suffix").isin(*IMAGES, "pdf")
    checked = files.withColumn("suffix", F.when(known, F.col("suffix")).otherwise(F.raise_error(F.concat(F.lit("unsupported format: "), F.col("path")))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in PAGE_SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for stem, suffix, content in zip(batch.stem, batch.suffix, batch.content, strict=True):
                own = {"doc_id": stem, "dpi": dpi, "rotation_applied": 0, "deskew_angle": 0.0, "deskew_matrix": [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]}
                if render is not None:
                    rows += [own | page for page in render(content, suffix, dpi)]
                elif suffix == "pdf":
                    raise SourceError(f"{stem}: a PDF needs a renderer")
                else:
                    rows.append(own | {"page": 1, "content": content})
            made = pd.DataFrame(rows, columns=names)
            yield made.astype({c: "Int32" for c in ("page", "width_px", "height_px", "dpi", "rotation_applied")} | {c: "float64" for c in ("deskew_angle", "pdf_width_pt", "pdf_height_pt")})

    return checked.select("stem", "suffix", "content").mapInPandas(run, PAGE_SCHEMA)


def page_count(content: bytes, suffix: str) -> int:
    """Pages of a file without rendering: 1 for an image, the page objects of a PDF."""
    if suffix in IMAGES:
        return 1
    if suffix == "pdf":
        return len(re.findall(rb"/Type\s*/Page(?![a-zA-Z])", content))
    raise SourceError(f"unsupported format: {suffix}")


def duplicate_keys(df: DataFrame, key: str, shown: str) -> DataFrame:
    """(key, n, shown): keys with more than one row, and the least and largest value of another column."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.array(F.min(shown), F.max(shown)).alias("shown")).where("n > 1")


def require_unique(df: DataFrame, key: str, shown: str) -> DataFrame:
    """df, or an error that names two rows which share a key."""
    twice = duplicate_keys(df, key, shown).orderBy(key).head(1)
    if twice:
        raise SourceError(f"{key} {twice[0][0]!r} occurs twice: {', '.join(map(str, twice[0].shown))}")
    return df


def file_index(files: DataFrame) -> DataFrame:
    """(stem, path): the first file in path order of each stem."""
    return files.groupBy("stem").agg(F.min("path").alias("path"))


def _docx_row(tr: ElementTree.Element) -> Iterator[tuple[int, int, bool, str]]:
    """(column, width, whether it continues the cell above, text) of the cells of a table row."""
    column = 0
    for tc in tr.iterfind(f"{_W}tc"):
        prop = lambda name: tc.find(f"{_W}tcPr/{_W}{name}")  # noqa: B023, E731
        width = 1 if prop("gridSpan") is None else int(prop("gridSpan").get(f"{_W}val", 1))
        goes_on = prop("vMerge") is not None and prop("vMerge").get(f"{_W}val") in (None, "continue")
        yield column, width, goes_on, "\n".join(map(_paragraph, tc.iterfind(f"{_W}p")))
        column += width


def docx_cells(table: ElementTree.Element) -> list[tuple[int, int, int, int, str]]:
    """(row, column, colspan, rowspan, text) of the cells of a table, merged ones once, by grid column.

    Rows are read from the last one up: a continuing cell hands its height to the cell above it.
    """
    out, below = [], {}
    for r, tr in reversed(list(enumerate(table.iterfind(f"{_W}tr")))):
        handed = {}
        for column, width, goes_on, text in _docx_row(tr):
            height = 1 + below.get(column, 0)
            if goes_on:
                handed[column] = height
            else:
                out.append((r, column, width, height, text))
        below = handed
    return sorted(out, key=lambda c: c[:2])


def _paragraph(p: ElementTree.Element) -> str:
    return "".join({f"{_W}t": n.text or "", f"{_W}tab": "\t", f"{_W}br": "\n"}.get(n.tag, "") for n in p.iter())


def docx_blocks(content: bytes) -> Iterator[tuple[str, ElementTree.Element]]:
    """Paragraphs (p) and tables (tbl) in document order."""
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{_W}body")
    for child in body if body is not None else ():
        if child.tag in (f"{_W}p", f"{_W}tbl"):
            yield child.tag.removeprefix(_W), child


def docx_table_html(table: ElementTree.Element) -> str:
    rows: dict[int, list[str]] = {}
    for r, _, width, height, text in docx_cells(table):
        spans = (f' colspan="{width}"' if width > 1 else "") + (f' rowspan="{height}"' if height > 1 else "")
        rows.setdefault(r, []).append(f"<td{spans}>{escape(text)}</td>")
    return "<table>" + "".join("<tr>" + "".join(rows[r]) + "</tr>" for r in sorted(rows)) + "</table>"


def docx_text(content: bytes) -> str:
    """Paragraphs and cells as lines, in document order."""
    out = []
    for kind, node in docx_blocks(content):
        out += [_paragraph(node)] if kind == "p" else [c[4] for c in docx_cells(node)]
    return "\n".join(out)


def docx_markdown(content: bytes) -> str:
    """Blocks joined by blank lines, blank ones dropped; tables as HTML."""
    blocks = [_paragraph(n) if k == "p" else docx_table_html(n) for k, n in docx_blocks(content)]
    return "\n\n".join(b for b in blocks if b.strip()) + "\n"


def docx_tables(content: bytes) -> list[str]:
    return [docx_table_html(n) for k, n in docx_blocks(content) if k == "tbl"]


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, path, text) of loose texts below a folder, docx included; two of one stem are an error."""
    files = binary_files(spark, folder).where(F.col("suffix").isin(*TEXTS))
    require_unique(files, "stem", "path")

    @F.pandas_udf(T.StringType())
    def docx(contents: pd.Series) -> pd.Series:
        return contents.map(docx_text)

    plain = files.where("suffix <> 'docx'").select(F.col("stem").alias("doc_id"), "path", F.decode("content", "UTF-8").alias("text"))
    return plain.unionByName(files.where("suffix = 'docx'").select(F.col("stem").alias("doc_id"), "path", docx("content").alias("text")))


def read_gold(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, path, text, metadata, pages, fields) of ground-truth pairs, JSON parts as JSON text, sorted by doc_id.

    A JSON file must be an object with doc_id and text_file, a bare name of a file beside it; doc_id must be unique.
    """
    raw = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select("value", F.col("_metadata.file_path").alias("path"))
    get = lambda k: F.get_json_object("value", f"$.{k}")
    records = raw.select("path", F.regexp_replace("path", r"[^/]+$", "").alias("folder"), get("doc_id").alias("doc_id"), get("text_file").alias("text_file"), F.coalesce(get("metadata"), F.lit("{}")).alias("metadata"), F.coalesce(get("pages"), F.lit("[]")).alias("pages"), get("fields").alias("fields"))
    bad = records.where(F.coalesce("doc_id", F.lit("")).isin("") | F.coalesce("text_file", F.lit("")).isin("") | F.col("text_file").contains("/")).orderBy("path").head(1)
    if bad:
        raise SourceError(f"{bad[0].path}: doc_id and a bare text_file are needed")
    require_unique(records, "doc_id", "path")
    texts = spark.read.text(folder, wholetext=True, recursiveFileLookup=True).select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("text_path"))
    out = records.join(texts, F.concat("folder", "text_file") == F.col("text_path"), "left")
    missing = out.where("text_path is null").orderBy("path").head(1)
    if missing:
        raise SourceError(f"{missing[0].path}: {missing[0].text_file} is missing")
    return out.select("doc_id", "path", "text", "metadata", "pages", "fields").orderBy("doc_id")


def gold_records(texts: DataFrame, existing: DataFrame, originals: DataFrame) -> DataFrame:
    """(doc_id, json, markdown) for loose texts (doc_id, text) that have no record yet (existing: doc_id); originals: stem, path."""
    new = texts.join(existing.select("doc_id"), "doc_id", "left_anti").join(originals.select(F.col("stem").alias("doc_id"), F.col("path").alias("file")), "doc_id", "left")
    record = F.struct("doc_id", F.regexp_extract("file", r"([^/]+)$", 1).alias("file"), F.concat("doc_id", F.lit(".md")).alias("text_file"))
    return new.select("doc_id", F.to_json(record).alias("json"), F.col("text").alias("markdown"))


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return bool(system.globStatus(folder))


def read_snapshots(spark: SparkSession, path: str, schema: str | T.StructType = DOCUMENT_SCHEMA) -> DataFrame:
    """(doc_id, schema, ...) of document snapshots, files <doc_id>.document.json; a missing file and another schema version are errors."""
    if not exists(spark, path):
        raise SourceError(f"{path}: no snapshot there")
    version = F.when(F.col("schema") == 1, F.col("schema")).otherwise(F.raise_error(F.concat(F.lit("unsupported schema "), F.coalesce(F.col("schema").cast("string"), F.lit("none")))).cast("int"))
    doc_id = F.regexp_replace(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1), r"(\.document)?\.json$", "").alias("doc_id")
    rows = spark.read.schema(schema).json(path, multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    return rows.select(doc_id, "*").withColumn("schema", version)


def read_artifacts(spark: SparkSession, root: str, sha256: str, version: str) -> DataFrame:
    """Pages (doc_id, schema, geometry, elements) below root/<first 12 of sha256>/<version>/pages; a wrong geometry is an error."""
    g = F.col("geometry")
    wrong = geometry_error(g["rotation_applied"], g["deskew_matrix"], g["pdf_width_pt"], g["pdf_height_pt"])
    rows = read_snapshots(spark, f"{root.rstrip('/')}/{sha256[:12]}/{version}/pages", ARTIFACT_SCHEMA)
    return rows.withColumn("geometry", F.when(wrong.isNull(), g).otherwise(F.raise_error(wrong).cast(rows.schema["geometry"].dataType)))


def source_stems(meta: DataFrame) -> DataFrame:
    """meta (path, value: JSON) with the stem of its source, or null."""
    source = F.get_json_object("value", "$.source")
    return meta.select("path", F.nullif(F.regexp_replace(F.regexp_extract(source, r"([^/\\]+)$", 1), r"\.[^.]*$", ""), F.lit("")).alias("stem"))


def newest_file(files: DataFrame, *patterns: str) -> DataFrame:
    """(path) of the newest file whose path matches the first pattern that any does; empty if none does."""
    rank = F.coalesce(*[F.when(F.col("path").rlike(p), F.lit(-k)) for k, p in enumerate(patterns)])
    return files.withColumn("rank", rank).where("rank is not null").agg(F.max_by("path", F.struct("rank", "modificationTime", "path")).alias("path")).where("path is not null")
