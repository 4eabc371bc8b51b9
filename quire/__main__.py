"""Commands: python -m quire COMMAND ...; 0 if all went well, 1 or 2 if not."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import labels, recognition, review, serialize
from quire.sources import config, files, writers

EMPTY = "nothing was scored: no prediction has a ground-truth record"


def _session() -> SparkSession:
    return SparkSession.builder.appName("quire").getOrCreate()


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, path, text) of the Markdown files below a folder; two of one stem are an error."""
    found = files.binary_files(spark, folder).where("suffix = 'md'")
    files.require_unique(found, "stem", "path")
    return found.select(F.col("stem").alias("doc_id"), "path", F.decode("content", "UTF-8").alias("text"))


def evaluate(args: argparse.Namespace) -> int:
    """Scores predictions against ground truth and writes the report."""
    if args.tier != "recognition":
        raise NotImplementedError(f"{args.tier} isn't scored by this command")
    given = config.run_config(args.config)
    folders = {"pred_dir": given.output_dir, "gt_dir": given.ground_truth_dir}
    pred, gold = config.evaluation_dirs(args.pred, args.gt, Path.cwd(), folders)
    spark = _session()
    pairs = recognition.pair(*[recognition.only_document(rows, args.doc) for rows in (predictions(spark, str(pred)), files.read_gold(spark, str(gold)))]).cache()
    if not pairs.where("reason is null").head(1):
        print(EMPTY, file=sys.stderr)
        return 1
    candidates, counts = recognition.table_candidates(pairs)
    tables = recognition.table_scores(recognition.greedy_pairs(candidates, args.table_threshold), counts).cache()
    text = recognition.render_report(recognition.score_wer(pairs).cache(), tables, pairs.select("doc_id", "reason"))
    print(writers.write_report(text, args.results, args.label or pred.name, gold.name))
    return 0


def convert(args: argparse.Namespace) -> int:
    """Makes ground-truth records of loose texts."""
    spark, out = _session(), args.out or args.source
    loose = files.read_texts(spark, args.source)
    known = files.binary_files(spark, out).where("suffix = 'json'") if Path(out).is_dir() else files.binary_files(spark, args.source).where("false")
    originals = files.file_index(files.binary_files(spark, args.source_dir)) if args.source_dir else spark.createDataFrame([], "stem string, path string")
    if Path(out).resolve() == Path(args.source).resolve() and (other := loose.where("path not like '%.md'").head(1)):
        raise files.SourceError(f"{other[0].path}: only .md files become records where they are; give --out")
    records = files.gold_records(loose, known.select(F.col("stem").alias("doc_id")), originals)
    written = writers.write_gold(records, out)
    print(f"wrote {sum(p.endswith('.json') for p in written)} records below {out}")
    return 0


def _read_document(spark: SparkSession, folder: str, stem: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    held = files.read_snapshots(spark, f"{folder}/{stem}/{stem}.document.json").withColumn("doc_id", F.lit(stem)).cache()
    part = lambda name: held.select("doc_id", F.explode(name).alias("p")).select("doc_id", "p.*")
    return held.select("doc_id", "source", "doc_sha256", "pipeline_version"), part("pages"), serialize.decoded_elements(held), part("errors")


def apply_review(args: argparse.Namespace) -> int:
    """Applies the corrected review pages of a document to its output."""
    given, spark = config.run_config(args.config, out=args.out), _session()
    documents, pages, elements, errors = _read_document(spark, given.output_dir, args.stem)
    folder = f"{given.review_dir}/{args.stem}"
    if not files.exists(spark, folder):
        raise review.ReviewError(f"{folder}: no review pages")
    found = files.binary_files(spark, folder).where("stem rlike '^p[0-9]+$' and suffix = 'md'")
    sent = review.require_valid(found.select(F.lit(args.stem).alias("doc_id"), "path", F.decode("content", "UTF-8").alias("body")))
    fixes = review.corrections(sent)
    text = elements.where("kind = 'text'")
    each = text.select("doc_id", "page", "reading_order", "id", F.posexplode("lines").alias("pos", "line")).select("doc_id", "page", "reading_order", "id", "pos", "line.*")
    numbered = review.page_lines(each)
    fixed = review.apply_corrections(numbered.select("doc_id", "page", "line_no", "text", "text_ocr"), fixes)
    bad = fixed.where("error is not null").orderBy("page").head(1)
    if bad:
        raise review.ReviewError(f"page {bad[0].page}: {bad[0].error}")
    lines = numbered.drop("text", "text_ocr").join(fixed.drop("error"), ["doc_id", "page", "line_no"])
    kept = [f.name for f in elements.schema["lines"].dataType.elementType.fields]
    made = lines.groupBy("doc_id", "id").agg(F.array_sort(F.collect_list(F.struct("pos", *kept))).alias("ls"))
    made = made.select("doc_id", "id", F.transform("ls", lambda x: F.struct(*[x[c].alias(c) for c in kept])).alias("new"))
    new = elements.join(made, ["doc_id", "id"], "left").withColumn("text", F.when(F.col("new").isNotNull(), F.array_join(F.transform("new", lambda x: x["text"]), "\n")).otherwise(F.col("text")))
    new = new.withColumn("lines", F.coalesce("new", "lines")).drop("new").cache()
    written = writers.write_documents(documents, pages, new, errors, given.output_dir, given.outputs)
    writers.clear_review(given.review_dir, args.stem, [r.page for r in fixes.select("page").distinct().collect()])
    print(f"ok apply-review {args.stem} -> {', '.join(written)}")
    return 0


def align(args: argparse.Namespace) -> int:
    """Labels the lines of a document's artifact pages from its ground truth; writes labels and the log of rejected lines."""
    given, spark = config.run_config(args.config), _session()
    artifact = files.read_artifacts(spark, given.artifacts_dir, args.sha, args.version)
    lines = labels.text_lines(serialize.decoded_elements(artifact.withColumn("doc_id", F.lit(args.sha[:12]))))
    lines = labels.number_lines(lines).select("doc_id", "page", "line_no", F.coalesce("text_ocr", "text").alias("text"))
    gold = files.read_gold(spark, given.ground_truth_dir)
    gold = (gold.where(F.col("doc_id") == args.stem) if args.stem else gold).select(F.lit(args.sha[:12]).alias("doc_id"), "text")
    found = review.page_slices(gold)
    every = lines.select("doc_id", "page").distinct()
    sliced = every.join(found.where("page is not null"), ["doc_id", "page"], "left").join(found.where("page is null").select("doc_id", F.col("text").alias("whole")), "doc_id", "left")
    made = labels.align_lines(lines, sliced.select("doc_id", "page", F.coalesce("text", "whole").alias("text"))).cache()
    name = F.format_string("%s/p%04d_l%04d.gt.txt", "doc_id", "page", "line_no").alias("path")
    written = writers.write_files(made.where("label is not null").select(name, F.col("label").alias("content")), args.data_dir)
    print(f"{len(written)} labels written, {writers.write_rejects(labels.rejects(made), args.data_dir)} lines rejected")
    return 0


def training_list(args: argparse.Namespace) -> int:
    """Lists the training files of labelled pairs."""
    spark = _session()
    pairs = labels.labelled_pairs(files.binary_files(spark, args.data_dir).select(F.regexp_replace("path", "^file:", "").alias("path")))
    print(writers.write_training_list(labels.training_list(pairs), args.data_dir))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="python -m quire")
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, run, failed: int, *options: tuple) -> None:
        command = commands.add_parser(name, help=(run.__doc__ or "").strip())
        for flags, settings in options:
            command.add_argument(*flags.split(), **settings)
        command.set_defaults(run=run, failed=failed)

    settings = ("--config", {})
    add("evaluate", evaluate, 1, ("tier", {"choices": ["recognition", "layout", "extraction"]}), ("--pred", {}), ("--gt", {}), settings, ("--label", {}), ("--doc", {}), ("--table-threshold", {"type": float, "default": recognition.FLOOR}), ("--results", {"default": "results"}))
    add("convert", convert, 1, ("source", {}), ("--out", {}), ("--source-dir", {}))
    add("apply-review", apply_review, 2, ("stem", {}), settings, ("--out", {}))
    add("align", align, 2, ("--sha", {"required": True}), ("--version", {"required": True}), ("--stem", {}), ("--data-dir", {"default": "data/train"}), settings)
    add("training-list", training_list, 2, ("--data-dir", {"default": "data/train"}))
    return top


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return args.run(args)
    except (ValueError, NotImplementedError, PySparkException) as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return args.failed


if __name__ == "__main__":
    raise SystemExit(main())
