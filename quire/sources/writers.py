"""What runs leave behind: documents, snapshots, review pages, records, reports and logs.

Rows become files where they are: each task writes its own through a file system that executors share, first under
another name, so a task that is run again leaves whole files and no others. Only names and counts come to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.serialize import to_coco, to_document_json, to_markdown
from quire.sources.config import OUTPUTS


class WriteError(ValueError):
    """Something that can't be written as asked."""


def _at(root: str) -> tuple[fs.FileSystem, str]:
    """A file system and the path of a folder in it, from a URI or a local path."""
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def write_files(files: DataFrame, root: str, overwrite: bool = True) -> list[str]:
    """Writes files (path below root, content string or binary); gives the paths written, in order. Without overwrite, files that exist stay."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, top = _at(root)
        for batch in batches:
            done = []
            for path, content in zip(batch.path, batch.content, strict=True):
                target = f"{top.rstrip('/')}/{path}"
                if not overwrite and system.get_file_info(target).type != fs.FileType.NotFound:
                    continue
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                unfinished = f"{target}.{uuid.uuid4().hex}"
                with system.open_output_stream(unfinished) as out:
                    out.write(bytes(content))
                system.move(unfinished, target)
                done.append(path)
            yield pd.DataFrame({"path": pd.Series(done, dtype=object)})

    rows = files.select("path", F.col("content").cast("binary").alias("content"))
    return sorted(r.path for r in rows.mapInPandas(run, "path string").toLocalIterator())


def write_documents(documents: DataFrame, pages: DataFrame, elements: DataFrame, errors: DataFrame, root: str, outputs: Sequence[str] = ("markdown",), snapshot: bool = True) -> list[str]:
    """root/<doc_id>/<doc_id>.md, .coco.json and .document.json for each document; an unknown output is an error before anything is written."""
    if unknown := sorted(set(outputs) - set(OUTPUTS)):
        raise WriteError(f"unknown output {unknown[0]!r}; there are {', '.join(OUTPUTS)}")
    name = lambda suffix: F.concat("doc_id", F.lit("/"), "doc_id", F.lit(suffix)).alias("path")
    made = []
    if "markdown" in outputs:
        whole = documents.select("doc_id").join(to_markdown(elements), "doc_id", "left")
        made.append(whole.select(name(".md"), F.coalesce("markdown", F.lit("\n")).alias("content")))
    if "coco" in outputs:
        made.append(to_coco(documents, pages, elements, errors).select(name(".coco.json"), F.col("coco").alias("content")))
    if snapshot:
        made.append(to_document_json(documents, pages, elements, errors).select(name(".document.json"), F.col("snapshot").alias("content")))
    return [path for files in made for path in write_files(files, root)]


def write_review(pages: DataFrame, images: DataFrame, root: str) -> list[str]:
    """Review pages (doc_id, page, name, body) and their images (doc_id, page, content) as root/<doc_id>/pNNNN.md and .webp; a page without an image is an error."""
    both = pages.join(images.select("doc_id", "page", F.col("content").alias("image")), ["doc_id", "page"], "left")
    missing = both.where("image is null").orderBy("doc_id", "page").head(1)
    if missing:
        raise WriteError(f"{missing[0].doc_id}: page {missing[0].page} has no image")
    at = lambda c: F.concat("doc_id", F.lit("/"), c).alias("path")
    texts = write_files(both.select(at("name"), F.col("body").alias("content")), root)
    return texts + write_files(both.select(at(F.regexp_replace("name", r"\.md$", ".webp")), F.col("image").alias("content")), root)


def clear_review(root: str, doc_id: str, numbers: Sequence[int]) -> None:
    """Deletes the files of applied pages and, if nothing is left, the document's folder."""
    system, top = _at(f"{root.rstrip('/')}/{doc_id}")
    for n in numbers:
        for suffix in ("md", "webp"):
            path = f"{top}/p{n:04d}.{suffix}"
            if system.get_file_info(path).type == fs.FileType.File:
                system.delete_file(path)
    if system.get_file_info(top).type == fs.FileType.Directory and not system.get_file_info(fs.FileSelector(top)):
        system.delete_dir(top)


def write_gold(records: DataFrame, root: str) -> list[str]:
    """Records (doc_id, json, markdown) as root/<doc_id>.json and .md; records that exist are never replaced."""
    files = lambda suffix, column: records.select(F.concat("doc_id", F.lit(suffix)).alias("path"), F.col(column).alias("content"))
    return sorted(write_files(files(".md", "markdown"), root, overwrite=False) + write_files(files(".json", "json"), root, overwrite=False))


def write_text(root: str, path: str, text: str, append: bool = False) -> str:
    """One text as a file: a report or, with append, further lines of a log."""
    system, top = _at(root)
    target = f"{top.rstrip('/')}/{path}"
    system.create_dir(target.rsplit("/", 1)[0], recursive=True)
    old = b""
    if append and system.get_file_info(target).type == fs.FileType.File:
        with system.open_input_stream(target) as held:
            old = held.read()
    with system.open_output_stream(target) as out:
        out.write(old + text.encode())
    return target


def write_report(report: str, root: str, label: str, dataset: str) -> str:
    return write_text(root, f"{label}/{dataset}.md", report)


def write_rejects(rejects: DataFrame, root: str) -> int:
    """Appends (name, reason) to root/rejected.log, a line each; gives their number."""
    lines = [f"{r.name}: {r.reason}\n" for r in rejects.orderBy("name").toLocalIterator()]
    if lines:
        write_text(root, "rejected.log", "".join(lines), append=True)
    return len(lines)


def write_training_list(paths: DataFrame, root: str, name: str = "list.train") -> str:
    return write_text(root, name, "".join(f"{r.path}\n" for r in paths.orderBy("path").toLocalIterator()))
