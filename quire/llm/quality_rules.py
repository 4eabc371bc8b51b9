"""Quality rules with fixed base limits and adaptive thresholds for each language and source.

One pass over the texts measures them. Four ratios go into quantile sketches: a histogram with bins of
DIGITS significant binary digits for each (lang, source) and ratio, some 64 bins for each doubling, so that a
quantile is off by less than 1.6 % whatever its size. Sketches merge by adding counts, so partial ones combine
before the shuffle and the result doesn't depend on the order. A limit is the upper quartile plus `spread` times
the interquartile range (at least a floor for each ratio, so that a group where nearly all texts agree isn't cut
to pieces); a text above any limit of its group is rejected, and so is one that fails the base limits. Texts
are judged by their own ratios, not by bins.

The ratios: symbols for each word, words in repeated three-word windows for each word, and repeated lines for each line
with a word, in thousandths; and the mean word length in hundredths of a character, which has a lower limit as well.

Nulls and edges: a null or blank text has no words and fails the base limits; null lang and null
source are values of their own; a null doc_id stays; repeated rows are judged one by one; an
empty table gives an empty result; other columns pass through the filter unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.llm.common import columns_of, free_names, guarded_broadcast, materialize, named

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SPREAD = 3.0
#: What the interquartile range counts at least, in the units of the ratios.
FLOORS = {"symbols": 30, "repeats": 100, "lines": 170, "length": 500}
#: Binary digits of a ratio that its bin keeps.
DIGITS = 7
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_SYMBOLS = b"#*$%&|<>"
#: The bytes of UTF-8 that don't begin a code point.
_CONTINUATION = bytes(range(0x80, 0xC0))


def measure(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """The METRICS of a UTF-8 text."""
    text = text or b""
    words = text.split()
    n = len(words)
    continuing = len(text) - len(text.translate(None, _CONTINUATION))
    chars = sum(map(len, words)) - continuing
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    seen: set[bytes] = set()
    lines = again = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            again += line in seen
            seen.add(line)
    repeat = 0
    if n >= 3:
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
        keys = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:] if len(number) < 2_000_000 else _ranked(ids)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        equal = ordered[1:] == ordered[:-1]
        at = order[np.r_[equal, False] | np.r_[False, equal]]
        hit = np.zeros(n, dtype=bool)
        for k in range(3):
            hit[at + k] = True
        repeat = int(hit.sum())
    return n, chars, symbols, again, repeat, lines


def _ranked(ids: np.ndarray) -> np.ndarray:
    """Keys of three-word windows where the product of three numbers would overflow."""
    pair = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)[1].astype(np.int64)
    return np.unique(pair[:-1] * (int(ids.max()) + 1) + ids[2:], return_inverse=True)[1]


def measured(docs: DataFrame, names: dict[str, str], keep: list[str]) -> DataFrame:
    """The columns `keep` of docs and the METRICS under the given names, from whole texts."""
    plain = [*[f"c{k}" for k in range(len(keep))], *METRICS]  # Arrow functions take no names with dots or backticks
    fields = [T.StructField(p, docs.schema[c].dataType) for p, c in zip(plain, keep, strict=False)]
    schema = T.StructType([*fields, *[T.StructField(m, T.LongType()) for m in METRICS]])
    # A text that is kept is measured where it stands; else it goes along as a column of its own.
    sent = [k for k, c in enumerate(keep) if c.lower() == "text" and isinstance(docs.schema[c].dataType, T.StringType)]
    at_text = sent[0] if sent else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(at_text)
                texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else pa.binary())
                found = np.array([measure(x) for x in texts.to_pylist()], dtype=np.int64).reshape(-1, len(METRICS))
                made = [pa.array(found[:, k]) for k in range(len(METRICS))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(plain) - len(METRICS)], *made], plain)

    rows = docs.select(*[named(c).alias(p) for p, c in zip(plain, keep, strict=False)], *([] if sent else [F.col("text").cast("binary").alias("text")]))
    return rows.mapInArrow(run, schema).toDF(*keep, *[names[m] for m in METRICS])


def _ratios(n: dict[str, str]) -> dict[str, F.Column]:
    per = lambda a, times, b: F.expr(f"{n[a]} * {times} div greatest(1, {n[b]})")
    return {"symbols": per("n_symbols", 1000, "n_words"), "repeats": per("n_repeat_words", 1000, "n_words"), "lines": per("n_dup_lines", 1000, "n_lines"), "length": per("word_chars", 100, "n_words")}


def sketches(metrics: DataFrame) -> DataFrame:
    """(lang, source, ratio, bin, n): the merged sketches of measured rows with columns lang and source; a bin is the least value in it."""
    ratios = _ratios({m: m for m in METRICS})
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), v.alias("v")) for k, v in ratios.items()])).alias("r")
    rows = metrics.where("n_words > 0").select("lang", "source", each).select("lang", "source", "r.ratio", "r.v")
    width = f"shiftleft(1L, greatest(0, length(bin(v)) - {DIGITS}))"
    return rows.groupBy("lang", "source", "ratio", F.expr(f"v div {width} * {width}").alias("bin")).agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame, spread: float = SPREAD) -> DataFrame:
    """(lang, source, most_<ratio>..., least_length): what a text of the group may have, from merged sketches."""
    group = Window.partitionBy("lang", "source", "ratio")
    upto = F.sum("n").over(group.orderBy("bin"))
    at = sketch.select("lang", "source", "ratio", "bin", upto.alias("upto"), F.sum("n").over(group).alias("total"))
    quantile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bin")))
    q = at.groupBy("lang", "source", "ratio").agg(quantile(1).alias("q1"), quantile(3).alias("q3"))
    floor = F.create_map(*[x for k, v in FLOORS.items() for x in (F.lit(k), F.lit(v))])[F.col("ratio")]
    reach = F.greatest(F.col("q3") - F.col("q1"), floor) * spread
    q = q.select("lang", "source", "ratio", (F.col("q3") + reach).alias("most"), (F.col("q1") - reach).alias("least"))
    pick = lambda c, k: F.max(F.when(F.col("ratio") == k, F.col(c)))
    return q.groupBy("lang", "source").agg(*[pick("most", k).alias(f"most_{k}") for k in FLOORS], pick("least", "length").alias("least_length"))


def _base_failed(n: dict[str, str]) -> F.Column:
    return F.expr(f"{n['n_words']} < {MIN_WORDS} or 100 * {n['n_repeat_words']} > {MAX_REPEAT_PERCENT} * {n['n_words']}")


def judged(rows: DataFrame, limits: DataFrame, names: dict[str, str], lang: str, source: str, failed: str, kept: str) -> DataFrame:
    """rows with the columns `failed` and `kept`; lang and source name the group columns of rows."""
    own = dict(zip(limits.columns, free_names(rows, *limits.columns), strict=True))
    limits = guarded_broadcast(limits.withColumnsRenamed(own))
    out = rows.join(limits, F.col(lang).eqNullSafe(F.col(own["lang"])) & F.col(source).eqNullSafe(F.col(own["source"])), "left")
    ratios = _ratios(names)
    fine = F.col(own["least_length"]) <= ratios["length"]
    for k, v in ratios.items():
        fine &= v <= F.col(own[f"most_{k}"])
    base = _base_failed(names)
    return out.withColumns({failed: base, kept: ~base & F.coalesce(fine, F.lit(True))})


def quality_verdicts(docs: DataFrame, spread: float = SPREAD) -> DataFrame:
    """doc_id, lang, source, the METRICS, base_failed and kept for each row of docs."""
    names = {m: m for m in METRICS}
    docs = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    rows = materialize(measured(docs, names, ["doc_id", "lang", "source"]))
    out = judged(rows, materialize(thresholds(sketches(rows), spread)), names, "lang", "source", "base_failed", "kept")
    return out.select("doc_id", "lang", "source", *METRICS, "base_failed", "kept")


def keep_good(docs: DataFrame, spread: float = SPREAD) -> DataFrame:
    """The rows of docs that pass, with the columns of docs. Texts are measured twice and never shuffled."""
    thin = docs.select(F.col("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    limits = materialize(thresholds(sketches(measured(thin, {m: m for m in METRICS}, ["lang", "source"])), spread))
    *own, failed, kept = free_names(docs, *METRICS, "base_failed", "kept")
    names = dict(zip(METRICS, own, strict=True))
    out = judged(measured(docs, names, docs.columns), limits, names, "lang", "source", failed, kept)
    return out.where(F.col(kept)).select(*columns_of(docs))
