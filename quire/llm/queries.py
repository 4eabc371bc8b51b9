"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import chat_format, decontaminate, lm_score, packing, quality_classifier, quality_rules, secret_scan, simhash_dedup, substring_dedup, url_filter
from quire.llm.common import table
from quire.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(table(spark, sf_dir, "documents"), with_ids=False)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "source", "n_lines")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(table(spark, sf_dir, "documents"))
    counts = {f"n_{k}": secret_scan.counted("base", k) for k in ("assign", "access", "hex")}
    digest = F.sha2(secret_scan.rendered("base"), 256)
    return found.select("doc_id", *[v.alias(k) for k, v in counts.items()], digest.alias("base_sha256"), secret_scan.rendered("spans").alias("spans"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.render(table(spark, sf_dir, "conversations"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_simhash_dedup": op1_simhash_dedup,
        "op2_packing": op2_packing,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_decontaminate": op4_decontaminate,
        "op5_quality_rules": op5_quality_rules,
        "op6_secret_scan": op6_secret_scan,
        "op7_chat_format": op7_chat_format,
        "op8_url_filter": op8_url_filter,
        "op9_lm_score": op9_lm_score,
        "op10_quality_classifier": op10_quality_classifier,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
