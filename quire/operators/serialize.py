"""Documents as Markdown, COCO annotations and JSON snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.assemble import chain_heads

ASIDE_MARK = "<!-- ann-aside -->"
PREFIXES = {"title": "# ", "section-header": "## ", "list-item": "- "}
#: Layout classes in the order of their category ids from 1.
CLASSES = ("caption", "footnote", "formula", "list-item", "page-footer", "page-header", "picture", "section-header", "table", "text", "title")
SCHEMA_VERSION = 1


def rows_of(html: Column) -> Column:
    """From the first row of a table to the end of its last row."""
    start, end = F.locate("<tr", html), F.locate(">rt/<", F.reverse(html))
    return F.when((start > 0) & (end > 0), F.substring(html, start, F.length(html) - end + 2 - start)).otherwise(F.lit(""))


def splice(html: Column, rows: Column) -> Column:
    """html with rows before its first </tbody>, else before its first </table>."""
    at = F.when(F.locate("</tbody>", html) > 0, F.locate("</tbody>", html)).otherwise(F.locate("</table>", html))
    return F.when((at > 0) & (rows != ""), F.concat(F.substring(html, F.lit(1), at - 1), rows, F.substring(html, at, F.length(html)))).otherwise(html)


def markdown_blocks(elements: DataFrame) -> DataFrame:
    """(doc_id, id, reading_order, render, block) of the elements that aren't inlined.

    elements: doc_id, id, category, reading_order, render, kind (text, table, figure, formula or null), text,
    html, latex, path, caption_id, continues_from, flags.
    """
    tail = elements.where("continues_from is not null")
    heads = chain_heads(tail.select("doc_id", F.col("continues_from").alias("head"), F.col("id").alias("tail")))
    parts = tail.join(heads, ["doc_id", "id"]).groupBy("doc_id", "head").agg(F.array_sort(F.collect_list(F.struct("reading_order", "id", rows_of(F.col("html")).alias("rows")))).alias("parts"))
    parts = parts.select("doc_id", F.col("head").alias("id"), F.array_join(F.transform("parts", lambda p: p["rows"]), "").alias("more"))
    captions = elements.select("doc_id", F.col("id").alias("caption_id"), F.coalesce("text", F.lit("")).alias("caption"))
    shown = elements.where("render <> 'inlined'").join(parts, ["doc_id", "id"], "left").join(captions, ["doc_id", "caption_id"], "left")
    caption = F.coalesce("caption", F.lit(""))
    bad = F.filter(F.coalesce("flags", F.array().cast("array<string>")), lambda f: f.endswith("_failed") | f.endswith("_disabled"))
    prefix = F.lit("")
    for kind, text in PREFIXES.items():
        prefix = F.when(F.col("category") == kind, text).otherwise(prefix)
    table = splice(F.col("html"), F.coalesce("more", F.lit("")))
    body = (
        F.when(F.col("kind") == "table", F.when(caption != "", F.concat(table, F.lit("\n\n"), caption)).otherwise(table))
        .when(F.col("kind") == "figure", F.concat(F.lit("!["), caption, F.lit("]("), F.col("path"), F.lit(")")))
        .when(F.col("kind") == "formula", F.concat(F.lit("$$"), F.col("latex"), F.lit("$$")))
        .otherwise(F.concat(prefix, F.col("text")))
    )
    anchor = F.format_string("<!-- ann:%d -->", "id")
    empty = F.concat(F.format_string("<!-- ann:%d ", "id"), F.coalesce(F.get(bad, 0), F.lit("empty")), F.lit(" -->"))
    block = F.when(F.col("kind").isNull(), empty).otherwise(F.concat(anchor, F.lit("\n"), body))
    return shown.select("doc_id", "id", "reading_order", "render", block.alias("block"))


def to_markdown(elements: DataFrame) -> DataFrame:
    """(doc_id, markdown): flow blocks, then the aside mark and asides if there are any, with blank lines between and a final newline."""
    of = lambda render: F.transform(F.array_sort(F.collect_list(F.when(F.col("render") == render, F.struct("reading_order", "id", "block")))), lambda b: b["block"])
    per = markdown_blocks(elements).groupBy("doc_id").agg(of("flow").alias("flow"), of("aside").alias("aside"))
    aside = F.when(F.size("aside") > 0, F.concat(F.array(F.lit(ASIDE_MARK)), F.col("aside"))).otherwise(F.array().cast("array<string>"))
    made = per.select("doc_id", F.concat(F.array_join(F.concat("flow", aside), "\n\n"), F.lit("\n")).alias("markdown"))
    every = elements.select("doc_id").distinct()
    return every.join(made, "doc_id", "left").withColumn("markdown", F.coalesce("markdown", F.lit("\n")))


def category_id(category: Column) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in CLASSES]), category).cast("int")


def annotations(elements: DataFrame) -> DataFrame:
    """(doc_id, id, annotation): COCO annotations as JSON; what an element lacks is left out; logprob hides rec_score.

    elements: doc_id, id, page, category, bbox, reading_order, render, polygon, rec_score, flags, text, html and, if they have them, logprob, latex and path.
    """
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    logprob, more = _part(elements, "logprob", "double"), [c for c in ("latex", "path") if c in elements.columns]
    ring = F.when(F.size("polygon") > 0, F.array(F.flatten(F.transform("polygon", lambda p: F.array(p["x"], p["y"])))))
    made = F.struct(
        "id", F.col("page").alias("image_id"), category_id(F.col("category")).alias("category_id"),
        F.array("bbox.x", "bbox.y", "bbox.w", "bbox.h").alias("bbox"), (F.col("bbox.w").cast("long") * F.col("bbox.h")).alias("area"), F.lit(0).alias("iscrowd"),
        ring.alias("segmentation"), "reading_order", "render", logprob.alias("logprob"), F.when(logprob.isNull(), F.col("rec_score")).alias("rec_score"), some("flags").alias("flags"), "text", "html", *more,
    )
    return elements.select("doc_id", "id", F.to_json(made).alias("annotation"))


def to_coco(documents: DataFrame, pages: DataFrame, elements: DataFrame, errors: DataFrame) -> DataFrame:
    """(doc_id, coco) as JSON: info with page errors, an image for each page that succeeded, categories, annotations.

    documents: doc_id, source; pages: doc_id, page, width_px, height_px; errors: doc_id, page, stage, message.
    """
    images = pages.join(documents, "doc_id").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(F.col("page").alias("id"), F.format_string("%s#page=%d", "source", "page").alias("file_name"), F.col("width_px").alias("width"), F.col("height_px").alias("height")))).alias("images"))
    notes = annotations(elements).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "annotation"))), lambda a: a["annotation"]).alias("annotations"))
    failed = errors.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "stage", "message"))).alias("page_errors"))
    out = documents.join(images, "doc_id", "left").join(notes, "doc_id", "left").join(failed, "doc_id", "left")
    kinds = F.array(*[F.struct(F.lit(k).alias("id"), F.lit(c).alias("name")) for k, c in enumerate(CLASSES, 1)])
    listed = lambda c: F.concat(F.lit("["), F.array_join(F.coalesce(c, F.array().cast("array<string>")), ","), F.lit("]"))
    info = F.to_json(F.struct(F.col("source").alias("description"), "page_errors"))
    as_json = lambda c: F.coalesce(F.to_json(c), F.lit("[]"))
    return out.select("doc_id", F.concat(F.lit('{"info":'), info, F.lit(',"images":'), as_json("images"), F.lit(',"categories":'), F.to_json(kinds), F.lit(',"annotations":'), listed("annotations"), F.lit("}")).alias("coco"))


def to_snapshot(elements: DataFrame) -> DataFrame:
    """(doc_id, snapshot): all elements of a document as JSON with nulls kept; neither score nor log-probability appears if both are null."""
    columns = [c for c in elements.columns if c not in ("doc_id", "rec_score", "logprob")]
    keep = {"ignoreNullFields": "false"}
    plain = F.to_json(F.struct(*columns), keep)
    scores = F.to_json(F.struct(*[c for c in ("rec_score", "logprob") if c in elements.columns]), keep)
    has = F.col("rec_score").isNotNull() | F.col("logprob").isNotNull()
    one = F.when(has, F.concat(F.expr("substring(plain, 1, length(plain) - 1)"), F.lit(","), F.expr("substring(scores, 2)"))).otherwise(F.col("plain"))
    rows = elements.select("doc_id", "id", plain.alias("plain"), scores.alias("scores"), "rec_score", "logprob").select("doc_id", "id", one.alias("one"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "one"))), lambda r: r["one"]), ",")
    return rows.groupBy("doc_id").agg(F.concat(F.lit(f'{{"schema":{SCHEMA_VERSION},"elements":['), listed, F.lit("]}")).alias("snapshot"))


_LINE = "struct<text:string,text_ocr:string,polygon:array<array<double>>,confidence:double>"
_GEOMETRY = "struct<page:int,width_px:int,height_px:int,dpi:int,rotation_applied:int,deskew_angle:double,deskew_matrix:array<double>,pdf_width_pt:double,pdf_height_pt:double>"
_CONTENT = f"struct<kind:string,text:string,lines:array<{_LINE}>,html:string,n_rows:int,n_cols:int,cell_boxes:array<array<int>>,latex:string,path:string>"
_ELEMENT = f"struct<id:bigint,page:int,category:string,bbox:array<int>,polygon:array<array<double>>,reading_order:int,render:string,layout_score:double,caption_id:bigint,continues_from:bigint,flags:array<string>,content:{_CONTENT},rec_score:double,logprob:struct<sum:double,mean:double,min:double,n_tokens:int>>"
#: What a document's snapshot holds, and a page's.
DOCUMENT_SCHEMA = f"schema int, source string, doc_sha256 string, pipeline_version string, pages array<{_GEOMETRY}>, elements array<{_ELEMENT}>, errors array<struct<page:int,stage:string,message:string>>"
PAGE_SCHEMA = f"schema int, geometry {_GEOMETRY}, elements array<{_ELEMENT}>"
#: The parts of each kind of content, in order.
PARTS = {"text": ("text", "lines"), "table": ("html", "n_rows", "n_cols", "cell_boxes"), "formula": ("latex",), "figure": ("path",)}
_PART_TYPES = {"text": "string", "lines": f"array<{_LINE}>", "html": "string", "n_rows": "int", "n_cols": "int", "cell_boxes": "array<array<int>>", "latex": "string", "path": "string"}
_KEEP = {"ignoreNullFields": "false"}


def _part(elements: DataFrame, name: str, kind: str) -> Column:
    """A column of elements, or null of its kind; an absent list is empty."""
    if name in elements.columns:
        return F.col(name)
    return (F.array() if kind.startswith("array") else F.lit(None)).cast(kind)


def _spliced(*parts: Column) -> Column:
    """JSON objects as one, in order."""
    inner = [F.substring(p, F.lit(2), F.length(p) - 2) for p in parts]
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.when(i != "", i) for i in inner]), F.lit("}"))


def element_json(elements: DataFrame) -> Column:
    """An element as JSON, nulls kept; rec_score and logprob appear if either is known, and no content is null."""
    plain = [("bbox", F.array("bbox.x", "bbox.y", "bbox.w", "bbox.h")), ("polygon", F.transform(_part(elements, "polygon", "array<struct<x:double,y:double>>"), lambda p: F.array(p["x"], p["y"])))]
    plain = dict(plain)
    names = ("id", "page", "category", "bbox", "polygon", "reading_order", "render", "layout_score", "caption_id", "continues_from", "flags")
    types = {"layout_score": "double", "caption_id": "bigint", "continues_from": "bigint", "flags": "array<string>"}
    own = F.to_json(F.struct(*[(plain.get(n) if n in plain else _part(elements, n, types.get(n, "string"))).alias(n) for n in names]), _KEEP)
    content = F.lit("null")
    for kind, parts in PARTS.items():
        made = F.to_json(F.struct(F.col("kind"), *[_part(elements, c, _PART_TYPES[c]).alias(c) for c in parts]), _KEEP)
        content = F.when(F.col("kind") == kind, made).otherwise(content)
    content = F.concat(F.lit('{"content":'), content, F.lit("}"))
    scores = F.struct(_part(elements, "rec_score", "double").alias("rec_score"), _part(elements, "logprob", "struct<sum:double,mean:double,min:double,n_tokens:int>").alias("logprob"))
    known = scores["rec_score"].isNotNull() | scores["logprob"].isNotNull()
    return _spliced(own, content, F.when(known, F.to_json(scores, _KEEP)).otherwise(F.lit("{}")))


def to_document_json(documents: DataFrame, pages: DataFrame, elements: DataFrame, errors: DataFrame) -> DataFrame:
    """(doc_id, snapshot): a whole document as JSON, nulls kept.

    documents: doc_id, source, doc_sha256, pipeline_version; pages: doc_id and page geometries; errors: doc_id, page, stage, message.
    """
    listed = lambda rows, order: F.transform(F.array_sort(F.collect_list(F.struct(*order, "json"))), lambda r: r["json"])
    geometry = [c.split(":")[0] for c in _GEOMETRY[7:-1].replace("array<double>", "").split(",")]
    parts = {
        "pages": pages.select("doc_id", "page", F.to_json(F.struct(*[F.col(c) if c in pages.columns else F.lit(None).cast("double").alias(c) for c in geometry]), _KEEP).alias("json")).groupBy("doc_id").agg(listed(pages, ["page"]).alias("pages")),
        "elements": elements.select("doc_id", "id", element_json(elements).alias("json")).groupBy("doc_id").agg(listed(elements, ["id"]).alias("elements")),
        "errors": errors.select("doc_id", "page", F.to_json(F.struct("page", "stage", "message"), _KEEP).alias("json")).groupBy("doc_id").agg(listed(errors, ["page"]).alias("errors")),
    }
    head = F.struct(F.lit(SCHEMA_VERSION).alias("schema"), *[(F.col(c) if c in documents.columns else F.lit(None).cast("string")).alias(c) for c in ("source", "doc_sha256", "pipeline_version")])
    out = documents.select("doc_id", F.to_json(head, _KEEP).alias("head"))
    for name, rows in parts.items():
        out = out.join(rows, "doc_id", "left")
    bodies = [F.concat(F.lit(f'{{"{name}":['), F.array_join(F.coalesce(name, F.array().cast("array<string>")), ","), F.lit("]}")) for name in parts]
    return out.select("doc_id", _spliced(F.col("head"), *bodies).alias("snapshot"))


def decoded_elements(snapshots: DataFrame) -> DataFrame:
    """The elements of decoded snapshots (doc_id, elements) as rows, their content in columns, as the writers take them."""
    e = snapshots.select("doc_id", F.explode("elements").alias("e")).select("doc_id", "e.*")
    box = F.struct(*[F.get("bbox", i).alias(k) for i, k in enumerate("xywh")])
    ring = F.transform("polygon", lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))
    return e.withColumns({"bbox": box, "polygon": ring, **{c: F.col(f"content.{c}") for c in ("kind", *_PART_TYPES)}}).drop("content")
