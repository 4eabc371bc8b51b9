"""A quality classifier from positive and unlabelled texts.

Trusted positives are texts labelled 1, the unlabelled sample is drawn from all texts. The class prior is not estimated from
positives and unlabelled texts alone: it is the share of ones among the training labels, so the zeros count for
the prior and for nothing else. The model, a small network over text features, minimises the
non-negative unbiased risk: prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), with the
sigmoid loss; where the estimate of the negative part falls below zero its gradient is reversed.

Fitting takes a bounded sample of distinct (doc_id, text), at most POSITIVES and UNLABELLED, the first by a hash of
both, so that rows without a doc_id and with a repeated one are drawn like any other; it
runs on the driver in some 20 MB. Scoring covers every row in one pass without a shuffle.

Features come from the whole text alone: shares of byte pairs in hashed buckets and a few ratios.

Nulls and edges: a null or empty text is scored like any text, from features that are all zero; a null
doc_id is scored and never trains; a label that is null or contradicts another label of its
doc_id never trains; with no positives to learn from all scores are the prior (0.5 without labels); repeated rows are scored
one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import guarded_broadcast, materialize
from quire.llm.quality_rules import measure

FOLDS, HELD_OUT = 3, 1
POSITIVES, UNLABELLED = 4096, 12_288
BUCKETS = 64
RATIOS = 9
HIDDEN, STEPS, RATE, DECAY = 16, 400, 0.01, 1e-3
#: Byte pairs, which are many, count this much less than the ratios.
PAIR_WEIGHT = 0.2


def features(text: bytes | None) -> np.ndarray:
    """BUCKETS shares of byte pairs, as square roots, and RATIOS ratios."""
    text = (text or b"").lower()
    out = np.zeros(BUCKETS + RATIOS, dtype=np.float32)
    b = np.frombuffer(text, dtype=np.uint8).astype(np.int64)
    if len(b) > 1:
        pairs = np.bincount((b[:-1] * 31 + b[1:] * 7 + (b[:-1] >> 3)) % BUCKETS, minlength=BUCKETS)
        out[:BUCKETS] = np.sqrt(pairs / (len(b) - 1))
    if len(b):
        n, chars, symbols, again, repeat, lines = measure(text)
        words = max(1, n)
        digits = np.count_nonzero((b >= 48) & (b <= 57))
        other = np.count_nonzero((b > 32) & (b < 127) & ~((b >= 97) & (b <= 122)) & ~((b >= 48) & (b <= 57)))
        out[BUCKETS:] = [np.log1p(n) / 5, np.sqrt(symbols / words), np.sqrt(repeat / words), np.sqrt(again / max(1, lines)), chars / words / 10, np.sqrt(digits / len(b)), np.sqrt(other / len(b)), len(set(text.split())) / words, 1.0]
    return out


def _forward(x: np.ndarray, w: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ w[0] + w[1])
    return hidden, hidden @ w[2] + w[3]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> list[np.ndarray]:
    """Weights that minimise the non-negative risk; full-batch Adam."""
    rng = np.random.default_rng(seed)
    mean, spread = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    spread[:BUCKETS] /= PAIR_WEIGHT
    positive, unlabelled = (positive - mean) / spread, (unlabelled - mean) / spread
    d = positive.shape[1]
    w = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for step in range(1, STEPS + 1):
        grads = [DECAY * x for x in w]
        hp, zp = _forward(positive, w)
        hu, zu = _forward(unlabelled, w)
        sp, su = _sigmoid(zp), _sigmoid(zu)
        slope_p, slope_u = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
        negative_risk = su.mean() - prior * sp.mean()
        if negative_risk >= 0:  # losses: 1 - s for a positive, s for a negative
            parts = ((positive, hp, -prior * slope_p - prior * slope_p), (unlabelled, hu, slope_u))
        else:
            parts = ((positive, hp, prior * slope_p), (unlabelled, hu, -slope_u))
        for x, h, g in parts:
            back = g[:, None] * w[2] * (1 - h * h)
            for grad, add in zip(grads, (x.T @ back, back.sum(0), h.T @ g, np.array([g.sum()])), strict=True):
                grad += add
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] = w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return [w[0] / spread[:, None], w[1] - (mean / spread) @ w[0], w[2], w[3]]


def _as_features(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([features(x).tobytes() for x in batch.column("text").to_pylist()], pa.binary())], ["x"])

    return texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "x binary")


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """(text) of at most `most` distinct (doc_id, text) of rows, the first by their hash.

    A first pass over hashes alone finds a limit that about 1.2 * most rows pass, so that few texts are moved.
    """
    hashed = rows.withColumn("order", F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1 << 40)))
    share = min(1.0, 1.2 * most / max(1, hashed.agg(F.approx_count_distinct("order")).first()[0]))
    few = hashed.where(F.col("order") < int(share * (1 << 40))).dropDuplicates(["doc_id", "text"])
    return few.orderBy("order").limit(most).select("text").repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _matrix(df: DataFrame) -> np.ndarray:
    rows = df.toArrow().column("x").to_pylist()
    return np.array([np.frombuffer(x, dtype=np.float32) for x in rows], dtype=np.float64).reshape(-1, BUCKETS + RATIOS)


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[np.ndarray] | None, float]:
    """Weights, or None without positives, and the class prior."""
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    given = labels.where(F.col("doc_id").isNotNull() & (fold != HELD_OUT) & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("quality")).where("low = quality")
    zeros, ones = given.agg(F.count_if(F.col("quality") == 0), F.count_if(F.col("quality") == 1)).first()
    if not ones:
        return None, 0.5 if not zeros else 0.0
    prior = ones / (ones + zeros)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    trusted = guarded_broadcast(materialize(given.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))))
    positive = _matrix(_as_features(_sample(texts.join(trusted, "doc_id", "left_semi"), POSITIVES)))
    unlabelled = _matrix(_as_features(_sample(texts, UNLABELLED)))
    return (fit(positive, unlabelled, min(prior, 0.99)) if len(positive) else None), prior


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs (doc_id, text), learnt from labels (doc_id, quality)."""
    weights, prior = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = np.array([features(t) for t in part.column("text").to_pylist()], dtype=np.float64).reshape(-1, BUCKETS + RATIOS)
                score = _sigmoid(_forward(x, weights)[1]) if weights is not None else np.full(len(x), prior)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
