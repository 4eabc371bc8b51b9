"""Removal of word passages that occur more than once, by Rabin-Karp window hashes.

Every window of `window` words of every text has a rolling hash: with 64-bit word hashes w and an
odd base b, sum(w[i+k] * b^k) modulo 2^64. Equal hashes count as equal windows; words aren't compared again. Two unrelated
windows agree with probability 2^-64; two that have the same words in another order with at most 2^-57, as the
differences of powers of b are divisible by up to 2^7 within a window. (With 10^9 windows that makes about 0.03 expected false
repeats among unrelated ones, with 10^11 some 270.)

Counting is one shuffle. A task groups its texts into chunks of about a million words and sends,
for each chunk and hash bucket, one binary row with the distinct hashes of the chunk and where
they start; what a chunk repeats within itself is combined beforehand, so that a passage
shared by a third of all texts sends one entry for each chunk and not for each text. A bucket counts and answers
each chunk with the starts whose hash is also elsewhere; a chunk merges these into maximal
intervals for each text, which a join brings to the texts, without a shuffle of these where few have any. The number of buckets follows
the bytes of text, so that a bucket keeps its size when the corpus grows.

Windows are judged on the input: all copies of a repeated passage go, not all but one.

Nulls and edges: a null or blank text has no words; a text shorter than a window keeps all of
them; a null doc_id is a value of its own; repeated rows are texts that repeat each other; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bucket_count, dealt, guarded_broadcast, materialize

WINDOW = 35
CHUNK_WORDS = 1 << 20
BASE = 0x9E3779B97F4A7C15
CACHED_WORDS = 300_000
_REST = np.uint64((1 << 56) - 1)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, BASE, dtype=np.uint64)
    down = np.full(n + 1, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _packed(hashes: np.ndarray) -> bytes:
    """The low 7 bytes of each hash; the bucket has the highest one."""
    return hashes.view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), dtype=np.uint8)
    out[:, :7] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 7)
    return out.reshape(-1).view(np.uint64)


class _Chunk:
    """Texts of one task until they have about CHUNK_WORDS words."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        self.words: list[np.ndarray] = []
        self.docs: list[tuple] = []
        self.n = 0

    def add(self, doc_id: int | None, text_hash: int, words: np.ndarray) -> None:
        self.words.append(words)
        self.docs.append((doc_id, text_hash, len(words)))
        self.n += len(words)

    def rows(self, up: np.ndarray, down: np.ndarray) -> pa.RecordBatch:
        w, size = np.concatenate(self.words), self.window
        sums = np.r_[np.uint64(0), np.cumsum(w * up[: len(w)], dtype=np.uint64)]
        hashes = (sums[size:] - sums[:-size]) * down[: len(w) - size + 1]
        ends = np.cumsum([d[2] for d in self.docs])
        starts = np.ones(len(hashes), dtype=bool)
        for end in ends[:-1].tolist():
            starts[end - size + 1 : end] = False
        at = np.flatnonzero(starts)
        hashes = hashes[at]
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        single = new & np.r_[new[1:], True]
        many = ordered[new & ~single]
        repeated = np.zeros(len(w), dtype=bool)
        repeated[at[order[~single]]] = True
        chosen = np.sort(order[single])
        hashes, at = hashes[chosen], at[chosen].astype(np.uint32)
        shift = np.uint64(64 - (self.buckets.bit_length() - 1))
        bucket = (hashes >> shift).astype(np.int64)
        by = np.argsort(bucket.astype(np.uint16 if self.buckets <= 1 << 16 else np.int64), kind="stable")
        hashes, at = hashes[by], at[by]
        cut = np.searchsorted(bucket[by], np.arange(self.buckets + 1))
        cut_many = np.searchsorted((many >> shift).astype(np.int64), np.arange(self.buckets + 1))
        chunk = xxhash.xxh64_intdigest(w.tobytes() + repr(self.docs).encode()) >> 1
        keys, blobs = [], []
        for k in range(self.buckets):
            a, b = cut[k], cut[k + 1]
            more = many[cut_many[k] : cut_many[k + 1]]
            if b > a or len(more):
                steps = np.diff(at[a:b], prepend=np.uint32(0))
                steps = steps.astype("<u2" if not len(steps) or steps.max() < 1 << 16 else "<u4")
                blobs.append(np.array([b - a, steps.itemsize], dtype="<u4").tobytes() + _packed(hashes[a:b]) + steps.tobytes() + _packed(more))
                keys.append(k)
        frame = pd.DataFrame(self.docs, columns=["doc_id", "text_hash", "n"])
        side = pa.BufferOutputStream()
        table = pa.table({"doc_id": pa.array(frame.doc_id.tolist(), pa.int64(), from_pandas=True), "text_hash": pa.array(frame.text_hash.tolist(), pa.int64()), "n": pa.array(frame.n.tolist(), pa.int64())})
        with pa.ipc.new_stream(side, table.schema) as out:
            out.write_table(table)
        side = side.getvalue().to_pybytes()
        blobs.append(np.array([len(side)], dtype="<u4").tobytes() + side + np.packbits(repeated).tobytes())
        keys.append(-1 - chunk % self.buckets)
        return pa.RecordBatch.from_arrays([pa.array([chunk] * len(keys), pa.int64()), pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["chunk", "bucket", "data"])


def _window_rows(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """(chunk, bucket, data): the hashes of a chunk in a bucket; under a negative bucket, what the chunk holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHash()
        up = down = np.zeros(0, dtype=np.uint64)
        chunk = _Chunk(window, buckets)

        def flushed() -> pa.RecordBatch:
            nonlocal up, down, chunk
            if chunk.n > len(up):
                up, down = _powers(max(chunk.n, CHUNK_WORDS))
            out, chunk = chunk.rows(up, down), _Chunk(window, buckets)
            return out

        for batch in batches:
            for doc_id, text_hash, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")), strict=True):
                words = (text or b"").split()
                if len(words) >= window:
                    chunk.add(doc_id, text_hash, np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words)))
                    if chunk.n >= CHUNK_WORDS:
                        yield flushed()
        if chunk.n:
            yield flushed()

    return docs.select("doc_id", "text_hash", F.col("text").cast("binary").alias("text")).mapInArrow(run, "chunk long, bucket long, data binary")


def _answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """For each chunk, the starts in this bucket whose hash is also elsewhere."""
    if key[0] < 0:
        return rows[["chunk", "data"]].assign(answer=False)
    singles, places, manies = [], [], []
    for data in rows["data"]:
        n, step = (int(x) for x in np.frombuffer(data, dtype="<u4", count=2))
        singles.append(_unpacked(data[8 : 8 + 7 * n]))
        places.append(np.cumsum(np.frombuffer(data, dtype=f"<u{step}", offset=8 + 7 * n, count=n), dtype=np.uint32))
        manies.append(_unpacked(data[8 + (7 + step) * n :]))
    every = np.concatenate([*singles, *manies])
    order = np.argsort(every)
    ordered = every[order]
    equal = ordered[1:] == ordered[:-1]
    again = np.zeros(len(every), dtype=bool)
    again[order] = np.r_[equal, False] | np.r_[False, equal]
    out, at = [], 0
    for chunk, place in zip(rows["chunk"], places, strict=True):
        hit = place[again[at : at + len(place)]]
        at += len(place)
        if len(hit):
            out.append((chunk, hit.astype("<u4").tobytes(), True))
    return pd.DataFrame(out, columns=["chunk", "data", "answer"])


def _intervals(window: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        side = rows.loc[~rows["answer"], "data"].iloc[0]
        n = int(np.frombuffer(side, dtype="<u4", count=1)[0])
        docs = pa.ipc.open_stream(side[4 : 4 + n]).read_all()
        ends = np.cumsum(docs["n"].to_numpy())
        repeated = np.unpackbits(np.frombuffer(side[4 + n :], dtype=np.uint8), count=int(ends[-1])).astype(bool)
        for data in rows.loc[rows["answer"], "data"]:
            repeated[np.frombuffer(data, dtype="<u4")] = True
        starts = np.flatnonzero(repeated)
        doc = np.searchsorted(ends, starts, side="right")
        out = []
        cuts = np.flatnonzero(np.diff(doc)) + 1
        for part in np.split(np.arange(len(starts)), cuts) if len(starts) else []:
            k = int(doc[part[0]])
            s = starts[part] - (int(ends[k - 1]) if k else 0)
            first = np.r_[True, s[1:] > s[:-1] + window]
            last = np.r_[first[1:], True]
            out.append((docs["doc_id"][k].as_py(), docs["text_hash"][k].as_py(), s[first].tolist(), (s[last] + window).tolist()))
        made = pd.DataFrame(out, columns=["doc_id", "text_hash", "begins", "ends"])
        return made.assign(doc_id=made.doc_id.astype("Int64"))

    return run


def repeated_intervals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, begins, ends): the maximal word intervals [begin, end) to remove, for texts that have any."""
    buckets = bucket_count(docs)
    answers = dealt(_window_rows(docs, window, buckets), "bucket", buckets // 4).groupBy("bucket").applyInPandas(_answer, "chunk long, data binary, answer boolean")
    found = dealt(answers, "chunk", buckets // 16).groupBy("chunk").applyInPandas(_intervals(window), "doc_id long, text_hash long, begins array<long>, ends array<long>")
    return found.dropDuplicates(["doc_id", "text_hash"])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text (the kept words, joined by one space), n_words and n_removed for each row of docs."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    found = materialize(repeated_intervals(docs, window).withColumnsRenamed({"doc_id": "of", "text_hash": "of_hash"}))
    found = guarded_broadcast(found)
    joined = docs.join(found, (F.col("text_hash") == F.col("of_hash")) & F.col("doc_id").eqNullSafe(F.col("of")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, gone = [], [], []
            for text, begins, ends in zip(*(batch.column(c).to_pylist() for c in ("text", "begins", "ends")), strict=True):
                words = (text or b"").split()
                sizes.append(len(words))
                if begins:
                    kept = []
                    for a, b in zip([0, *ends], [*begins, len(words)], strict=True):
                        kept += words[a:b]
                    words = kept
                gone.append(sizes[-1] - len(words))
                texts.append(b" ".join(words))
            columns = [batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_words", "n_removed"])

    joined = joined.select("doc_id", F.col("text").cast("binary").alias("text"), "begins", "ends")
    return joined.mapInArrow(run, "doc_id long, text string, n_words long, n_removed long")
