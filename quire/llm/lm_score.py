"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Tokens are words, A-Z in lower case, and one end for each text, known by 64-bit hashes (with 10^8 distinct
words the expected number of pairs that agree by chance is below 0.001).

Counting: a task counts words, pairs and triples of words in chunks of about a million tokens and sends, for each chunk and
hash bucket, binary rows of hashes and counts. A bucket adds them up; it returns the exact word
counts and, for all n-grams, its segment of the filter. A count c has the level q = 1 + floor(log2 c), and the filter holds
the events (n-gram, 1) to (n-gram, q), so that probing until the first miss gives q back, too high
only by false positives. In its segment an n-gram is known by 32 bits of its hash (pairs and triples travel as these, sorted, as
differences): with n of them in a segment, a probe meets another's
bits with probability n / 2^32, far below the filter's own false positives. A segment has 8 bits for an event and 3 hash functions, whatever the size of the corpus: the filter
holds every n-gram and grows with them. The number of buckets follows the bytes of text, so that a bucket keeps its size.

Probing: a filter of at most MOST_BROADCAST bytes, which is checked, is broadcast to the workers. A larger one stays where it
is: each chunk of texts sends its distinct n-grams to their segments, one binary row for each segment,
gets their levels back and is scored with them. That goes in ROUNDS, each with its share of the rows, as what is sent and what comes back are on disk
together; a round's are deleted before the next. Both ways give the same scores.

Scoring: p(w | u v) = (c(u, v, w) + MU * p(w | v)) / (c(u, v) + MU), p(w | v) = (c(v, w) + MU * p(w)) / (c(v) + MU) and
p(w) = (c(w) + 1) / (N + V + 1), all counts from probes.
The base score uses exact counts: those of at most HEAD frequent words are broadcast; words that the filter doesn't
hold have none, as it forgets nothing; occurrences of all others meet their counts in a join on the hash.

Nulls and edges: a null or empty text is the end alone; a null doc_id is not held out and trains;
repeated rows count again; with no training text every count is zero; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bucket_count, dealt, materialize, release_shuffles

FOLDS, HELD_OUT = 7, 2
#: Tokens to a chunk when counting or sending probes, where large chunks combine more, and when scoring with a broadcast filter.
CHUNK_TOKENS, SCORE_TOKENS = 1 << 20, 1 << 18
CACHED_WORDS = 300_000
BITS_PER_EVENT, PROBES = 8, 3
#: Bytes of a filter that is still broadcast.
MOST_BROADCAST = 1 << 24
#: Rounds of probes that are sent; each row is scored in the one that its hash gives.
ROUNDS = 2
#: Exact counts of at most this many words are broadcast, 16 bytes each.
HEAD = 1 << 20
MU = 8.0
END = xxhash.xxh64_intdigest(b" end ")
START = xxhash.xxh64_intdigest(b" start ")
_U = np.uint64


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _pairs(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mixed(before * _U(0x9E3779B97F4A7C15) + word)


def _grams(tokens: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The hashes of the word, pair and triple that end at each token; START stands before a text."""
    before = _before(tokens, at)
    pairs = _pairs(before, tokens)
    return [_mixed(tokens), pairs, _pairs(_before(before, at), pairs)]


def _tokens(texts: list[bytes | None], cache: _WordHash) -> tuple[np.ndarray, np.ndarray]:
    """The token hashes of the texts one after another, each with its end, and where each begins and the last ends."""
    parts, at = [], [0]
    for text in texts:
        words = (text or b"").lower().split()
        parts.append(np.fromiter(map(cache.__getitem__, words), dtype=_U, count=len(words)))
        parts.append(np.array([END], dtype=_U))
        at.append(at[-1] + len(words) + 1)
    return np.concatenate(parts) if parts else np.zeros(0, dtype=_U), np.array(at)


def _before(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.r_[_U(START), tokens[:-1]]
    out[at[:-1]] = START
    return out


def _chunks(batches: Iterator[pa.RecordBatch], column: str, tokens: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about so many tokens at most, judged by bytes; a text is never cut."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // (4 * tokens)
        cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def _distinct(x: np.ndarray) -> np.ndarray:
    """np.unique by sorting; without indexes or counts NumPy has a hash table, here up to 50 times slower."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _steps(low: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as differences, a byte of all after another, as high bytes are mostly zero."""
    return np.diff(low.astype("<u4"), prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_steps(data: bytes | memoryview, n: int, at: int = 0) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8, offset=at, count=4 * n).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes, and the end."""
    return np.searchsorted((hashes >> _U(65 - buckets.bit_length())).astype(np.int64), np.arange(buckets + 1))


def _blobs(hashes: np.ndarray, buckets: int, whole: bool) -> Iterator[tuple[int, bytes]]:
    """Bucket and binary row of the distinct hashes, whole or as their keys within the bucket, with their counts."""
    hashes, counts = np.unique(hashes, return_counts=True)
    cut = _cuts(hashes, buckets)
    low = hashes.view(np.uint8).reshape(-1, 8)[:, :7] if whole else _keys(hashes, 65 - buckets.bit_length())
    for k in np.flatnonzero(np.diff(cut)).tolist():
        a, b = cut[k], cut[k + 1]
        wide = "<u1" if counts[a:b].max() < 256 else "<u4"
        known = low[a:b].tobytes() if whole else _steps(low[a:b])
        yield k, np.array([b - a, int(wide[-1])], dtype="<u4").tobytes() + known + counts[a:b].astype(wide).tobytes()


def _added(rows: pd.Series, top: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of a bucket, in order, and their summed counts; keys within the bucket if its top byte isn't given."""
    hashes, counts, own = [], [], 4 if top is None else 7
    for data in rows:
        n, wide = (int(x) for x in np.frombuffer(data, dtype="<u4", count=2))
        if top is None:
            hashes.append(_from_steps(data, n, 8))
        else:
            full = np.full((n, 8), top, dtype=np.uint8)
            full[:, :7] = np.frombuffer(data, dtype=np.uint8, offset=8, count=7 * n).reshape(n, 7)
            hashes.append(full.reshape(-1).view(_U))
        counts.append(np.frombuffer(data, dtype=f"<u{wide}", offset=8 + own * n, count=n))
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    every, count = every[order], np.concatenate(counts).astype(np.int64)[order]
    new = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    return every[new], np.add.reduceat(count, new)


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1]


def _keys(grams: np.ndarray, shift: int) -> np.ndarray:
    """The 32 bits below those that choose the segment, by which a segment knows an n-gram."""
    return (grams << _U(64 - shift)) >> _U(32)


def _probe_bits(keys: np.ndarray, level: int | np.ndarray, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """The PROBES bit numbers of the events (key, level) within segments of so many bits."""
    event = _mixed(keys + np.asarray(level, dtype=_U) * _U(0xD1B54A32D192ED03))
    step = (event >> _U(32)) | _U(1)
    for k in range(PROBES):
        yield (event + _U(k) * step) % np.asarray(bits, dtype=_U)


def _segment(keys: np.ndarray, counts: np.ndarray, bits_per_event: int = BITS_PER_EVENT) -> bytes:
    """The bits of a segment that holds the events of n-grams with these keys."""
    level = _levels(counts)
    size = max(64, bits_per_event * int(level.sum()) // 64 * 64)
    held = np.zeros(size, dtype=bool)
    for q in range(1, int(level.max(initial=0)) + 1):
        for at in _probe_bits(keys[level >= q], q, size):
            held[at.astype(np.int64)] = True
    return np.packbits(held, bitorder="little").tobytes()


class LogFrequencyFilter:
    """Segments of bits; the high bits of an n-gram's hash choose its segment."""

    def __init__(self, segments: pa.Table, buckets: int):
        """segments: segment and data (bytes) of each; buckets without one are empty."""
        begin, size, bits = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64), bytearray()
        for k, data in zip(segments["segment"], segments["data"], strict=True):
            begin[k.as_py()], size[k.as_py()] = len(bits) * 8, len(data.as_buffer()) * 8
            bits += data.as_buffer()
        self.begin, self.size = begin, size
        self.bits = np.frombuffer(bits, dtype=np.uint8)
        self.shift = _U(65 - buckets.bit_length())

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The levels found by probing until the first miss, 0 if there is none."""
        level = np.zeros(len(grams), dtype=np.int64)
        segment = (grams >> self.shift).astype(np.int64)
        keys = _keys(grams, int(self.shift))
        live = np.flatnonzero(self.size[segment])
        q = 1
        while len(live):
            begin, size = self.begin[segment[live]], self.size[segment[live]]
            hit = np.ones(len(live), dtype=bool)
            for at in _probe_bits(keys[live], q, size):
                at = at.astype(np.int64) + begin
                hit &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            live = live[hit]
            level[live] = q
            q += 1
        return level

    def counts(self, grams: np.ndarray) -> np.ndarray:
        return estimated(self.levels(grams))


def estimated(level: np.ndarray) -> np.ndarray:
    """Estimated counts: the middle of the range that has the level, 0 for level 0."""
    return np.where(level > 0, (3 * np.exp2(level - 1.0) - 1) / 2, 0.0)


def count_ngrams(train: DataFrame, buckets: int, bits_per_event: int = BITS_PER_EVENT) -> DataFrame:
    """(kind, h, c, segment, data) as a table: exact word counts (kind 0: h, c) and filter segments (kind 1)."""

    def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHash()
        for part in _chunks(batches, "text", CHUNK_TOKENS):
            words, *more = _grams(*_tokens(part.column("text").to_pylist(), cache))
            for order, grams in ((0, words), (1, np.concatenate(more))):
                made = list(_blobs(grams, buckets, order == 0))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in made], pa.int64()), pa.array([order] * len(made), pa.int32()), pa.array([x for _, x in made], pa.binary())], ["bucket", "order", "data"])

    def totals(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bucket, shift = int(key[0]), 65 - buckets.bit_length()
        words, count = _added(rows.loc[rows["order"] == 0, "data"], (bucket << shift >> 56)) if (rows["order"] == 0).any() else (np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64))
        grams, many = _added(rows.loc[rows["order"] == 1, "data"], None) if (rows["order"] == 1).any() else (np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64))
        words = (words & _U((1 << shift) - 1)) | _U(bucket << shift)
        held = _segment(np.concatenate([_keys(words, shift), grams.astype(_U)]), np.concatenate([count, many]), bits_per_event)
        exact = pd.DataFrame({"kind": 0, "h": words.view(np.int64), "c": count, "segment": 0, "data": None})
        return pd.concat([exact, pd.DataFrame({"kind": [1], "h": [0], "c": [0], "segment": [bucket], "data": [held]})])

    rows = train.select(F.col("text").cast("binary").alias("text")).mapInArrow(chunk_rows, "bucket long, order int, data binary")
    return materialize(dealt(rows, "bucket", buckets // 4).groupBy("bucket").applyInPandas(totals, "kind int, h long, c long, segment int, data binary"))


def frequent_words(words: DataFrame, most: int = HEAD) -> tuple[np.ndarray, np.ndarray, float]:
    """Hashes, in order, and counts of the words above a limit that at most `most` words pass, and the limit."""
    step = F.floor(F.log2("c") * 4)
    by = sorted(((int(r[0]), int(r[1])) for r in words.groupBy(step.alias("s")).count().collect()), reverse=True)
    limit, n = float("inf"), 0
    for s, m in by:
        n += m
        if n > most:
            break
        limit = s
    found = words.where(step >= limit).select("h", "c").toArrow()
    h, c = found.column("h").to_numpy().view(_U), found.column("c").to_numpy()
    order = np.argsort(h)
    return h[order], c[order], limit


class _Scorer:
    """Scores chunks of texts; head_h and head_c are the exact counts of frequent words, total is N + V + 1."""

    COLUMNS = ("n_tokens", "known", "base", "score", "tail")
    SCHEMA = "n_tokens long, known long, base double, score double, tail array<long>"

    def __init__(self, head_h: np.ndarray, head_c: np.ndarray, total: int):
        self.head_h, self.head_c, self.total = head_h, head_c, total

    def __call__(self, tokens: np.ndarray, at: np.ndarray, lookup: Callable[[list[np.ndarray]], list[np.ndarray]]) -> list[pa.Array]:
        """The COLUMNS of each text; lookup gives the estimated counts of words, pairs and triples, tail has the words that aren't frequent but may be known."""
        grams = _grams(tokens, at)
        rough, pair, triple = lookup(grams)
        distinct, back = np.unique(grams[0], return_inverse=True)
        place = np.minimum(np.searchsorted(self.head_h, distinct), max(0, len(self.head_h) - 1))
        is_head = self.head_h[place] == distinct if len(self.head_h) else np.zeros(len(distinct), dtype=bool)
        exact = np.where(is_head, self.head_c[place], 0) if len(self.head_c) else np.zeros(len(distinct))
        known = is_head[back]
        unsure = ~known & (rough > 0)
        base = np.where(unsure, 0.0, np.log10((exact + 1) / self.total)[back])
        starts = rough[at[1] - 1]  # every text has an end
        context = self._context(rough, at, starts)
        pair = np.minimum(pair, context)
        before = self._context(pair, at, starts)
        triple = np.minimum(triple, before)
        p = (pair + MU * (rough + 1) / self.total) / (context + MU)
        score = np.log10((triple + MU * p) / (before + MU))
        sums = [np.add.reduceat(x, at[:-1]) for x in (base, score)]
        tail = np.flatnonzero(unsure)
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(tail, at), pa.int32()), pa.array(grams[0][tail].view(np.int64)))
        return [pa.array(np.diff(at)), pa.array(np.add.reduceat(known.astype(np.int64), at[:-1])), pa.array(sums[0]), pa.array(sums[1]), lists]

    @staticmethod
    def _context(counts: np.ndarray, at: np.ndarray, starts: float) -> np.ndarray:
        """The count of what stands before each token; before a text as many as there are texts."""
        out = np.r_[starts, counts[:-1]]
        out[at[:-1]] = starts
        return out


def _score_by_broadcast(source: DataFrame, segments: DataFrame, buckets: int, scorer: _Scorer, schema: str) -> DataFrame:
    """source (doc_id, held_out, text) scored by workers that hold the whole filter."""
    model = LogFrequencyFilter(segments.toArrow(), buckets)
    shared = source.sparkSession.sparkContext.broadcast((model, scorer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, scorer = shared.value
        cache = _WordHash()
        for part in _chunks(batches, "text", SCORE_TOKENS):
            made = scorer(*_tokens(part.column("text").to_pylist(), cache), lambda grams: list(map(model.counts, grams)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), *made], ["doc_id", "held_out", *scorer.COLUMNS])

    return source.mapInArrow(run, schema)


def _score_by_shuffle(source: DataFrame, segments: DataFrame, buckets: int, scorer: _Scorer, schema: str) -> DataFrame:
    """source (doc_id, held_out, text) scored with levels that each chunk gets from the segments of its n-grams.

    A chunk's own row holds its ids and its tokens as numbers of its distinct words, frequent ones first, in planes of bytes; it passes the segments unread, under a negative bucket.
    """
    shared = source.sparkSession.sparkContext.broadcast(scorer)
    shift = 65 - buckets.bit_length()
    fields = [pa.field("chunk", pa.int64()), pa.field("bucket", pa.int64()), pa.field("data", pa.binary())]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, task = _WordHash(), TaskContext.get().partitionId()
        for k, part in enumerate(_chunks(batches, "text", CHUNK_TOKENS)):
            tokens, at = _tokens(part.column("text").to_pylist(), cache)
            chunk = xxhash.xxh64_intdigest(np.array([task, k], dtype="<i8").tobytes() + tokens.tobytes()) >> 1
            words, back, times = np.unique(tokens, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")
            number = np.empty(len(words), dtype="<u4")
            number[order] = np.arange(len(words))
            planes = number[back].view(np.uint8).reshape(-1, 4).T
            rows = pa.table([part.column("doc_id"), part.column("held_out"), pa.array(np.diff(at))], ["doc_id", "held_out", "n"])
            side = pa.BufferOutputStream()
            with pa.ipc.new_stream(side, rows.schema) as out:
                out.write_table(rows)
            ids = side.getvalue().to_pybytes()
            raw = np.array([len(ids), len(words)], dtype="<i8").tobytes() + ids + words[order].tobytes() + planes.tobytes()
            keys, blobs = [-1 - chunk % buckets], [np.array([len(raw)], dtype="<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)]
            grams = _distinct(np.concatenate(_grams(tokens, at)))
            low, cut = _keys(grams, shift), _cuts(grams, buckets)
            for b in np.flatnonzero(np.diff(cut)).tolist():
                keys.append(b)
                blobs.append(_steps(low[cut[b] : cut[b + 1]]))
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(keys), pa.int64()), pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], schema=pa.schema(fields))

    def answer(key: tuple, rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket < 0:
            return rows
        held = rows.filter(pc.is_null(rows["chunk"]))
        asked = rows.filter(pc.is_valid(rows["chunk"]))
        model = LogFrequencyFilter(pa.table([held["bucket"], held["data"]], ["segment", "data"]), buckets)
        levels = []
        for data in asked["data"]:
            low = _from_steps(data.as_buffer(), len(data.as_buffer()) // 4).astype(_U) << _U(shift - 32)
            levels.append(model.levels(low | _U(bucket << shift)).astype(np.uint8).tobytes())
        return pa.table([asked["chunk"], asked["bucket"], pa.array(levels, pa.binary())], schema=pa.schema(fields))

    def finish(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("bucket")
        side = rows["data"][0].as_buffer()
        raw = pa.decompress(side[8:], int(np.frombuffer(side, dtype="<i8", count=1)[0]), codec="zstd")
        n_ids, n_words = np.frombuffer(raw, dtype="<i8", count=2).tolist()
        ids = pa.ipc.open_stream(raw[16 : 16 + n_ids]).read_all()
        words = np.frombuffer(raw[16 + n_ids :], dtype=_U, count=n_words)
        planes = np.frombuffer(raw[16 + n_ids + 8 * n_words :], dtype=np.uint8).reshape(4, -1)
        tokens = words[np.ascontiguousarray(planes.T).view("<u4").ravel()]
        at = np.r_[0, np.cumsum(ids["n"].to_numpy())]
        counts = estimated(np.frombuffer(b"".join(x.as_py() for x in rows["data"][1:]), dtype=np.uint8).astype(np.int64))
        made = shared.value(tokens, at, lambda grams: np.split(counts[np.unique(np.concatenate(grams), return_inverse=True)[1]], len(grams)))
        return pa.table([ids["doc_id"], ids["held_out"], *made], ["doc_id", "held_out", *_Scorer.COLUMNS])

    sent = source.mapInArrow(send, "chunk long, bucket long, data binary")
    held = segments.select(F.lit(None).cast("long").alias("chunk"), F.col("segment").cast("long").alias("bucket"), "data")
    answers = dealt(sent.union(held), "bucket", buckets // 4).groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, data binary")
    return answers.groupBy("chunk").applyInArrow(finish, schema)


def _in_rounds(source: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The scores of all rows of source with a number for each (row); every round's shuffles are deleted before the next begins."""
    done = []
    for k in range(ROUNDS):
        part = score(source.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == k))
        done.append(materialize(part.withColumn("row", F.monotonically_increasing_id() * ROUNDS + k)))
        release_shuffles(source.sparkSession)
    return reduce(DataFrame.unionByName, done)


def score_texts(docs: DataFrame, bits_per_event: int = BITS_PER_EVENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row of docs."""
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"))
    buckets = bucket_count(docs)
    table = count_ngrams(docs.where("not held_out"), buckets, bits_per_event)
    release_shuffles(docs.sparkSession)
    words = table.where("kind = 0").select("h", "c")
    train_tokens, distinct = (int(x or 0) for x in words.agg(F.sum("c"), F.count("*")).first())
    head_h, head_c, limit = frequent_words(words)
    total = train_tokens + distinct + 1
    segments = table.where("kind = 1").select("segment", "data")
    filter_bytes = int(segments.agg(F.sum(F.octet_length("data"))).first()[0] or 0)
    source = docs.select("doc_id", "held_out", F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scorer, schema = _Scorer(head_h, head_c, total), f"doc_id {kind}, held_out boolean, {_Scorer.SCHEMA}"
    if filter_bytes <= MOST_BROADCAST:
        scored = materialize(_score_by_broadcast(source, segments, buckets, scorer, schema).withColumn("row", F.monotonically_increasing_id()))
    else:
        scored = _in_rounds(source, lambda part: _score_by_shuffle(part, segments, buckets, scorer, schema))
    rare = scored.select("row", F.explode("tail").alias("h")).groupBy("row", "h").agg(F.count("*").alias("times")).join(words.where(F.floor(F.log2("c") * 4) < limit) if limit != float("inf") else words, "h", "left")
    count = F.coalesce("c", F.lit(0))
    per = rare.groupBy("row").agg(F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * F.log10((count + 1) / F.lit(float(total)))).alias("more_base"))
    out = scored.join(per, "row", "left")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(train_tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score")
