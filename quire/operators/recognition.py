"""Scoring of predicted texts against gold texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.alignment import wer
from quire.functions.normalize import before_aside
from quire.functions.tables import FLOOR, MOST_CANDIDATES, extract_tables, pair_greedily, table_similarity
from quire.operators.common import spread

NO_GOLD, NO_PREDICTION = "prediction has no ground-truth record", "ground truth has no prediction"


def pair(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """predicted and gold (doc_id, text) as (doc_id, predicted, gold, reason): a full outer join, so that what has no partner is named."""
    p = predicted.select("doc_id", F.col("text").alias("predicted"), F.lit(True).alias("has_p"))
    g = gold.select("doc_id", F.col("text").alias("gold"), F.lit(True).alias("has_g"))
    reason = F.when(F.col("has_g").isNull(), NO_GOLD).when(F.col("has_p").isNull(), NO_PREDICTION)
    return p.join(g, "doc_id", "full").select("doc_id", "predicted", "gold", reason.alias("reason"))


def only_document(rows: DataFrame, doc_id: str | None) -> DataFrame:
    """The rows of one document, or all."""
    return rows if doc_id is None else rows.where(F.col("doc_id") == doc_id)


def require_parsed(candidates: DataFrame) -> DataFrame:
    """candidates (doc_id, p, g, n_predicted, n_gold, ...), or an error where an extracted table has no tree."""
    side = F.when(F.col("n_predicted") == 0, F.concat(F.lit("predicted table "), F.col("p").cast("string"))).when(F.col("n_gold") == 0, F.concat(F.lit("gold table "), F.col("g").cast("string")))
    error = F.raise_error(F.concat(F.col("doc_id").cast("string"), F.lit(": "), side, F.lit(" can't be parsed")))
    return candidates.withColumn("n_gold", F.when(side.isNull(), F.col("n_gold")).otherwise(error.cast("int")))


def score_wer(pairs: DataFrame) -> DataFrame:
    """(doc_id, errors, n_words, ignored, wer) of paired texts; nulls where the gold has no words."""
    both = spread(pairs.where("reason is null"), "doc_id").select("doc_id", wer(before_aside(F.col("predicted")), F.col("gold")).alias("s"))
    return both.select("doc_id", "s.errors", "s.n_words", "s.ignored", (F.col("s.errors") / F.col("s.n_words")).alias("wer"))


def pool_wer(scores: DataFrame) -> DataFrame:
    """One row (errors, n_words, ignored, wer) of sums; wer is null without words."""
    out = scores.agg(*[F.sum(c).alias(c) for c in ("errors", "n_words", "ignored")])
    return out.withColumn("wer", F.try_divide("errors", "n_words"))


def encoded_words(words: Column, vocabulary: Column) -> Column:
    """Words as private characters by their places in a vocabulary, for levenshtein() on whole words."""
    code = F.transform(words, lambda w: F.lpad(F.hex(F.array_position(vocabulary, w) + 65536), 8, "0"))
    return F.decode(F.unhex(F.array_join(code, "")), "UTF-32")


def word_distance(predicted: Column, gold: Column) -> Column:
    """The edit distance of two word arrays, JVM side."""
    vocabulary = F.array_distinct(F.concat(predicted, gold))
    return F.levenshtein(encoded_words(predicted, vocabulary), encoded_words(gold, vocabulary))


def table_candidates(pairs: DataFrame, most: int = MOST_CANDIDATES) -> tuple[DataFrame, DataFrame]:
    """Candidates (doc_id, p, g, teds_struct, teds) and counts (doc_id, n_pred, n_gold, note).

    A document with more than `most` candidates has none and a note. The tables meet by document only, and pairs are dealt over all tasks.
    """
    both = pairs.where("reason is null").select("doc_id", extract_tables(before_aside(F.col("predicted"))).alias("ps"), extract_tables("gold").alias("gs"))
    over = F.size("ps") * F.size("gs") > most
    note = F.when(over, F.format_string(f"%d x %d tables exceeds the {most}-candidate cap", F.size("ps"), F.size("gs")))
    counts = both.select("doc_id", F.size("ps").alias("n_pred"), F.size("gs").alias("n_gold"), note.alias("note"))
    each = both.where(~over).select("doc_id", F.posexplode("ps").alias("p", "pt"), "gs").select("doc_id", "p", "pt", F.posexplode("gs").alias("g", "gt"))
    each = spread(each, "doc_id", "p", "g").select("doc_id", "p", "g", table_similarity("pt", "gt").alias("s"))
    each = require_parsed(each.select("doc_id", "p", "g", "s.*"))
    return each.where("n_gold > 0").select("doc_id", "p", "g", "teds_struct", "teds"), counts


_PAIR = T.StructType([T.StructField("p", T.IntegerType()), T.StructField("g", T.IntegerType()), T.StructField("teds_struct", T.DoubleType()), T.StructField("teds", T.DoubleType())])


def greedy_pairs(candidates: DataFrame, floor: float = FLOOR) -> DataFrame:
    """(doc_id, p, g, teds_struct, teds) of the greedy matching of each document; table_candidates caps a document's rows."""

    @F.pandas_udf(T.ArrayType(_PAIR))
    def match(rows: pd.Series) -> pd.Series:
        made = lambda cs: [dict(zip(_PAIR.names, f, strict=True)) for f in pair_greedily(((c["p"], c["g"], c["teds_struct"], c["teds"]) for c in cs), floor)]
        return rows.map(made)

    per = candidates.groupBy("doc_id").agg(F.collect_list(F.struct(*_PAIR.names)).alias("cs"))
    return per.select("doc_id", F.inline(match("cs")))


def table_scores(matched: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, teds, teds_struct, n_matched, n_gold, n_pred, table_recall, note): null, not zero, where nothing can be said."""
    per = matched.groupBy("doc_id").agg(F.avg("teds").alias("teds"), F.avg("teds_struct").alias("teds_struct"), F.count("*").alias("n_matched"))
    out = counts.join(per, "doc_id", "left").withColumn("n_matched", F.coalesce("n_matched", F.lit(0)))
    recall = F.when(F.col("note").isNull(), F.try_divide("n_matched", F.nullif("n_gold", F.lit(0))))
    return out.select("doc_id", "teds", "teds_struct", "n_matched", "n_gold", "n_pred", recall.alias("table_recall"), "note")


def pool_tables(scores: DataFrame) -> DataFrame:
    """One row of means weighted by matches, and the recall of sums."""
    weighted = lambda c: F.try_divide(F.sum(F.col(c) * F.col("n_matched")), F.nullif(F.sum("n_matched"), F.lit(0))).alias(c)
    recall = F.try_divide(F.sum("n_matched"), F.nullif(F.sum("n_gold"), F.lit(0)))
    return scores.agg(weighted("teds"), weighted("teds_struct"), *[F.sum(c).alias(c) for c in ("n_matched", "n_gold", "n_pred")], recall.alias("table_recall"))


def render_report(wer_rows: DataFrame, table_rows: DataFrame, unpaired: DataFrame, title: str = "Recognition") -> str:
    """The report as Markdown; it has a line for each document, so it is collected."""
    num = lambda x: "n/a" if x is None else f"{x:.4f}"
    pooled, tables = pool_wer(wer_rows).first(), pool_tables(table_rows).first()
    out = [f"# {title}", "", "## WER", "", "| document | WER | words | ignored |", "|---|---|---|---|"]
    out += [f"| {r.doc_id} | {num(r.wer)} | {r.n_words or 0} | {r.ignored or 0} |" for r in wer_rows.orderBy("doc_id").toLocalIterator()]
    out += [f"| **pooled** | {num(pooled.wer)} | {pooled.n_words or 0} | {pooled.ignored or 0} |", "", "## TEDS", "", "| document | TEDS | matched | gold | pred | note |", "|---|---|---|---|---|---|"]
    for r in table_rows.orderBy("doc_id").toLocalIterator():
        out.append(f"| {r.doc_id} | {'-' if not r.n_gold and not r.n_pred else num(r.teds)} | {r.n_matched} | {r.n_gold} | {r.n_pred} | {r.note or ''} |")
    out += [f"| **pooled** | {num(tables.teds)} | {tables.n_matched or 0} | {tables.n_gold or 0} | {tables.n_pred or 0} | |", "", "## Unpaired", ""]
    rows = [f"- {r.doc_id}: {r.reason}" for r in unpaired.where("reason is not null").orderBy("doc_id").toLocalIterator()]
    return "\n".join(out + (rows or ["None."])) + "\n"
