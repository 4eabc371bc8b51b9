"""Benchmark decontamination with SimHash windows, multi-index Hamming blocks and an exact check.

Words are what stands between ASCII white space, A-Z in lower case; shingles are five words, with
repeats. A benchmark item of n shingles is compared with windows of n shingles of a document (the whole
document if it has fewer). Similarity is the weighted Jaccard of the two shingle multisets:
shared occurrences over the larger count of each shingle, 0.8 or more.

1. A document's shingle hashes meet the items' shingle hashes. A window that is as similar as asked shares at
   least s / (1 + s) of both sizes' sum, so a document with fewer shared places than that is left; of all best
   windows one begins at a shared shingle or is the last, so only these windows are made. Nothing but shared
   places is shuffled, and only documents that have enough of them are read again.
2. The windows' 64-bit SimHashes come from bit counters that run over a document's shingles: a window's
   counts are those at its end less those at its begin, so its size costs nothing.
3. Items are indexed by 7 blocks of their SimHash, each with all values within floor(20 / 7) = 2 bits. A
   window looks up its 7 blocks; by the pigeonhole principle this finds every item within 20 bits. At
   similarity 0.8 the expected distance is 9.7 bits with a deviation of 2.9, so 20 leaves out
   less than one window in ten thousand at the very threshold and none of nearer copies.
4. Candidates are verified by the exact similarity. The j-th place of a shingle that an item has m times is shared
   by the windows that hold it but not the place m before it, which is a range of window begins; shared
   counts of all windows are a running sum over the ends of these ranges.

Every step is linear in words and shared places, whatever the length of items and documents: a window of
Spark runs over the places of one document that has passed step 1, and spills. Everything is DataFrame
functions. Small tables are broadcast only where their bytes are checked (MOST_BROADCAST), beyond that they are shuffled.

explode_outer, where nothing is null, keeps the optimizer from adding filters on the exploded
arrays and pushing them below the columns that they are made from, which would make these anew for each element;
filters on such columns stand behind a written table for the same reason.

Nulls and edges: null or blank texts and items have no shingles and match nothing; a text of one to four
words has one shingle, all its words; a null doc_id or item_id stays as null in the pairs;
repeated documents give repeated evidence for one pair, repeated items under other ids their
own pairs; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import ascii_lower, free_names, guarded_broadcast, materialize, words_of

WIDTH, SIMILARITY = 5, 0.8
BLOCKS = (9, 9, 9, 9, 9, 9, 10)
DISTANCE = 20
#: Counter k has the counts of bits k and k + 32 in two lanes of 32 bits.
LANES = 32
_BOTH = 0x0000000100000001
COUNTERS = [f"c{k}" for k in range(LANES)]


def with_shingles(df: DataFrame, text: str, name: str, width: int = WIDTH) -> DataFrame:
    """df with the hashes of the word shingles of a text, in order; one for all words if they are fewer than width.

    The word hashes are a column of their own, so that they are made once for a text.
    """
    df = df.withColumn(f"{name}_words", F.transform(words_of(ascii_lower(F.col(text))), lambda w: F.xxhash64(w)))
    w = F.col(f"{name}_words")
    rolled = F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
    made = F.when(F.size(w) >= width, rolled).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(name, made).drop(f"{name}_words")


def _lane(h: str, k: int) -> Column:
    return F.expr(f"shiftrightunsigned({h}, {k}) & {_BOTH}L")


def simhash_of(counters: list[str], size: str) -> Column:
    """The SimHash of LANES counters of `size` hashes: a bit is 1 if it is set in over half of them.

    What is added to a counter carries into bit 30 of a lane if the lane is over half of size; texts have fewer than 2^30 words.
    """
    bit = "shiftleft(shiftrightunsigned({c} + {most} * {both}L, 30) & {both}L, {k})"
    return F.expr(" | ".join(bit.format(c=c, most=f"({(1 << 30) - 1} - ({size}) div 2)", both=_BOTH, k=k) for k, c in enumerate(counters)))


def _keys(fp: str, probes: bool) -> Column:
    """Structs (block, value) of a fingerprint; with probes, also all values within reach."""
    reach, out = DISTANCE // len(BLOCKS), []
    for k, bits in enumerate(BLOCKS):
        masks = [sum(1 << i for i in c) for w in range(reach + 1 if probes else 1) for c in combinations(range(bits), w)]
        block = f"shiftrightunsigned({fp}, {sum(BLOCKS[:k])}) & {(1 << bits) - 1}L"
        out.append(f"transform(array({', '.join(f'{m}L' for m in masks)}), m -> named_struct('block', {k}, 'value', ({block}) ^ m))")
    return F.expr(f"concat({', '.join(out)})")


def indexed_items(benchmark: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Items (item, item_id, n, item_fp) and their shingles (item, n, h, times), as tables; item numbers the rows of benchmark."""
    made = with_shingles(benchmark.select("item_id", "text"), "text", "hs", width)
    made = materialize(made.select(F.monotonically_increasing_id().alias("item"), "item_id", F.size("hs").alias("n"), "hs")).where("n > 0")
    shingles = materialize(made.select("item", "n", F.explode_outer("hs").alias("h")).groupBy("item", "n", "h").agg(F.count("*").alias("times")))
    counters = [F.sum(_lane("h", k) * F.col("times")).alias(c) for k, c in enumerate(COUNTERS)]
    fps = shingles.groupBy("item", "n").agg(*counters).select("item", "n", simhash_of(COUNTERS, "n").alias("item_fp"))
    return materialize(fps.join(made.select("item", "item_id"), "item")), shingles


def _text_hash() -> Column:
    return F.xxhash64(F.col("text"))


def _same_row(df: DataFrame, other: DataFrame, doc_id: str, text_hash: str) -> Column:
    return (F.col("text_hash") == other[text_hash]) & F.col("doc_id").eqNullSafe(other[doc_id])


def sharing_documents(docs: DataFrame, shingles: DataFrame, similarity: float, width: int) -> DataFrame:
    """(doc_id, text_hash, hs, size, windows), as a table: documents that share enough places with items of n shingles, with the begins of the windows of n."""
    keyed = docs.select("doc_id", _text_hash().alias("text_hash"), "text")
    shared = guarded_broadcast(materialize(shingles.select("h", "n").distinct()))
    at = with_shingles(keyed, "text", "hs", width).select("doc_id", "text_hash", F.size("hs").alias("size"), F.posexplode_outer("hs").alias("pos", "h"))
    per = at.join(shared, "h").groupBy("doc_id", "text_hash", "size", "n").agg(F.collect_set("pos").alias("places"))
    least = F.lit(similarity / (1 + similarity) - 1e-9) * (F.least("size", "n") + F.col("n"))
    last = F.greatest(F.lit(0), F.col("size") - F.col("n"))
    begins = F.array_distinct(F.transform("places", lambda p: F.least(p, last)))
    per = per.where(F.size("places") >= least).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("n", begins.alias("begins"))).alias("windows"))
    per = guarded_broadcast(materialize(per.withColumnsRenamed({"doc_id": "d", "text_hash": "t"})))
    again = keyed.join(per, _same_row(keyed, per, "d", "t")).drop("d", "t").dropDuplicates(["doc_id", "text_hash"])
    return materialize(with_shingles(again, "text", "hs", width).select("doc_id", "text_hash", "hs", F.size("hs").alias("size"), "windows"))


def window_fingerprints(sharing: DataFrame) -> DataFrame:
    """(doc_id, text_hash, size, n, begin, first, fp): the SimHash of each window; first is its first shingle."""
    none = F.lit(None).cast("int")
    row = lambda at, kind, h, n, begin, first: F.struct(at.alias("at"), F.lit(kind).alias("kind"), h.alias("h"), n.alias("n"), begin.alias("begin"), first.alias("first"))
    zero = F.lit(0).cast("long")
    places = F.transform("hs", lambda h, i: row(i, 0, h, none, none, zero))
    edges = lambda kind, at: F.flatten(F.transform("windows", lambda w: F.transform(w["begins"], lambda b: row(at(w, b), kind, zero, w["n"], b, F.get("hs", b)))))
    ends = edges(2, lambda w, b: F.least(b + w["n"], F.col("size")) - 1)
    # Dealt before the places are rows of their own, which are many times the size of the arrays.
    whole = sharing.repartition(int(sharing.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "text_hash")
    each = whole.select("doc_id", "text_hash", "size", F.explode_outer(F.concat(places, edges(1, lambda w, b: b - 1), ends)).alias("e")).select("doc_id", "text_hash", "size", "e.*")
    sofar = Window.partitionBy("doc_id", "text_hash").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    counted = each.select("*", *[F.sum(_lane("h", k)).over(sofar).alias(c) for k, c in enumerate(COUNTERS)]).where("kind > 0")
    less = [F.expr(f"sum(if(kind = 2, {c}, -{c}))").alias(c) for c in COUNTERS]
    made = counted.groupBy("doc_id", "text_hash", "size", "n", "begin").agg(F.max("first").alias("first"), *less)
    return made.select("doc_id", "text_hash", "size", "n", "begin", "first", simhash_of(COUNTERS, "least(size, n)").alias("fp"))


def candidates(windows: DataFrame, items: DataFrame) -> DataFrame:
    """windows with each item (item, item_id) of n shingles within DISTANCE bits, found by the blocks."""
    index = items.select("item", "item_id", "n", "item_fp", F.explode_outer(_keys("item_fp", True)).alias("key"))
    index = guarded_broadcast(materialize(index.select("item", "item_id", "n", "item_fp", "key.block", "key.value")))
    keyed = windows.select("*", F.explode_outer(_keys("fp", False)).alias("key")).select("*", "key.block", "key.value").drop("key")
    near = keyed.join(index, ["n", "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= DISTANCE)
    return near.drop("block", "value", "fp", "item_fp").distinct()


def verified(found: DataFrame, sharing: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, text_hash, item_id, begin, similarity): candidates as similar as asked that begin at a shingle of their item or are the last window."""
    own = guarded_broadcast(shingles.select(F.col("item").alias("of"), F.col("h").alias("own"), "times"))
    begins = (F.col("item") == F.col("of")) & (F.col("first") == F.col("own"))
    asked = found.where(F.col("begin") >= F.col("size") - F.col("n")).unionByName(found.where(F.col("begin") < F.col("size") - F.col("n")).join(own, begins, "left_semi"))
    pairs = found.select("text_hash", "doc_id", "size", "n", "item", "item_id").distinct().withColumnsRenamed({"doc_id": "d", "text_hash": "t", "size": "s"})
    at = sharing.select("doc_id", "text_hash", "size", F.posexplode_outer("hs").alias("pos", "h"))
    places = at.join(pairs, (F.col("text_hash") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d"))).drop("d", "t", "s")
    places = places.join(own, (F.col("item") == F.col("of")) & (F.col("h") == F.col("own")))
    group = ["doc_id", "text_hash", "size", "item", "item_id", "n"]
    per = places.groupBy(*group, "h", "times").agg(F.array_sort(F.collect_list("pos")).alias("at"))
    first = lambda p, j: F.greatest(F.lit(0), p - F.col("n") + 1, F.coalesce(F.get("at", (j - F.col("times")).cast("int")) + 1, F.lit(0)))
    step = lambda x, kind, more: F.struct(x.cast("int").alias("begin"), F.lit(kind).alias("kind"), F.lit(more).alias("more"))
    steps = F.flatten(F.transform("at", lambda p, j: F.array(step(first(p, j), 0, 1), step(p + 1, 0, -1))))
    steps = per.select(*group, F.explode_outer(steps).alias("e")).select(*group, "e.*")
    steps = steps.unionByName(asked.select(*group, F.col("begin").cast("int").alias("begin"), F.lit(1).alias("kind"), F.lit(0).alias("more")))
    sofar = Window.partitionBy("doc_id", "text_hash", "item").orderBy("begin", "kind").rowsBetween(Window.unboundedPreceding, 0)
    shared = F.sum("more").over(sofar)
    counted = steps.withColumn("shared", shared).where("kind = 1")
    like = F.col("shared") / (F.least("size", "n") + F.col("n") - F.col("shared"))
    return counted.select("doc_id", "text_hash", "item_id", "begin", like.alias("similarity")).where(F.col("similarity") >= similarity)


def _matches(docs: DataFrame, benchmark: DataFrame, similarity: float, width: int) -> DataFrame:
    """(doc_id, text_hash, item_id, begin, similarity): the windows of rows of docs that are as similar to an item as asked."""
    items, shingles = indexed_items(benchmark, width)
    sharing = sharing_documents(docs, shingles, similarity, width)
    found = materialize(candidates(window_fingerprints(sharing), items))
    return verified(found, sharing, shingles, similarity)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """(doc_id, item_id, similarity, first_shingle): each document and each item that it contains, with the best window."""
    best = _matches(docs, benchmark, similarity, width).groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("begin")).alias("before"))).alias("best"))
    return best.select("doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.before")).cast("long").alias("first_shingle"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs, with their columns, that contain no item.

    Each row is judged on its own text, known by doc_id and the text's hash; doc_id may be null or repeated.
    The rows are shuffled only if the contaminated ones are too many to broadcast.
    """
    d, t = free_names(docs, "found_id", "found_hash")
    found = _matches(docs, benchmark, similarity, WIDTH).select(F.col("doc_id").alias(d), F.col("text_hash").alias(t)).distinct()
    found = guarded_broadcast(materialize(found))
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(d)) & (_text_hash() == F.col(t)), "left_anti")
