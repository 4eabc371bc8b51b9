"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Base patterns, leftmost and without overlap for each kind: assignments to names such as `token`, access
keys and hexadecimal strings. The method adds runs of 20 or more characters of the base64 alphabets
(with - and _) whose characters look drawn at random. For each run an encoding is inferred, the
smallest alphabet that holds it: hex, base32, base36 or base64; digits alone are numbers, not secrets.

* Chi-squared: the statistic against a uniform alphabet of k letters is about k - 1 for random
  text, while for L letters of words it is about (k - 1) + (L - 1) * d with a d that grows with the unevenness of
  the letters of words. Its left tail under the latter says how unlikely words are to look so even.
* Runs: the number of changes among digits, lower case, upper case and others, against a rate of 0.08 for words.
* Serial correlation: neighbouring characters of random text are uncorrelated; a run
  whose correlation is beyond chance (an alphabet, a counter, a repeated unit) isn't reported.

Fisher's method joins the first two. False discoveries are controlled by Benjamini and Hochberg's rule at
level ALPHA within each class of lengths, as many short runs would else decide for the few long ones. The
rule reads counts of p-values in fixed bins, which merge before the shuffle. Texts are read once and
never shuffled: a thin table holds the spans and runs found.

Everything is DataFrame functions. Positions are code points, the end exclusive.

Nulls and edges: a null or empty text has no spans; a null doc_id stays; repeated rows stay and are
scanned one by one; an empty table gives an empty result; other columns are ignored (the
redaction keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import columns_of, free_names, guarded_broadcast, materialize

#: kind, pattern, group whose length counts, least length. A longer least length inside the braces
#: finds the same runs as "+" and a check afterwards, as runs of one class don't overlap.
PATTERNS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
RUN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = [*[p[0] for p in PATTERNS], "random"]
#: encoding: pattern, letters, d.
ENCODINGS = (("hex", "^([0-9a-f]+|[0-9A-F]+)$", 16, 1.0), ("base32", "^[A-Z2-7]+=*$", 32, 1.1), ("base36", "^([a-z0-9]+|[A-Z0-9]+)$", 36, 1.4), ("base64", ".", 64, 3.0))
CHANGE_RATE, ALPHA, SERIAL_Z = 0.08, 0.001, 3.3
LENGTH_CLASSES = (32, 48, 80)
#: Matches whose places are added up at a time.
BLOCK = 128
BINS_PER_DECADE, MOST_BIN = 8, 8 * 60
REPLACEMENT = "[SECRET]"


_SPANS = "array<struct<start:int,end:int,size:int,run:string>>"


def _found(text: Column, pattern: str, group: int) -> Column:
    """Structs (start, end, size, run) of the matches: what lies between them gives the starts.

    Places are added up within blocks of BLOCK matches and then over blocks, so many matches don't cost their square.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.char_length)
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    steps = F.arrays_zip(F.transform(matches, F.char_length).alias("m"), gaps.alias("g"), sizes.alias("s"), matches.alias("t"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["g"]
        one = F.struct(start.alias("start"), (start + x["m"]).alias("end"), x["s"].alias("size"), x["t"].alias("run"))
        return F.struct((start + x["m"]).alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    def spans_of(block: Column) -> Column:
        """The spans of blocks of matches, from their places within their block."""
        befores = F.aggregate(block, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + b["at"])))
        moved = lambda x, by: F.struct((x["start"] + by).alias("start"), (x["end"] + by).alias("end"), x["size"].alias("size"), x["run"].alias("run"))
        return F.flatten(F.transform(F.arrays_zip(block.alias("b"), befores.alias("by")), lambda z: F.coalesce(F.transform(z["b"]["out"], lambda x: moved(x, z["by"])), F.array().cast(_SPANS))))

    held = F.filter(steps, lambda x: x["m"].isNotNull())
    blocks = lambda h: F.transform(F.sequence(F.lit(0), F.floor((F.size(h) - 1) / BLOCK).cast("int")), lambda c: F.aggregate(F.slice(h, c * BLOCK + 1, F.lit(BLOCK)), zero, step))
    once = lambda value, f: F.get(F.transform(F.array(value), f), 0)  # noqa: E731  a value that is used more than once is made once
    spans = once(held, lambda h: F.when(F.size(h) > 0, once(blocks(h), spans_of)).otherwise(F.array().cast(_SPANS)))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


def _as_spans(column: str, order: int, least: int) -> Column:
    long_enough = F.filter(column, lambda x: x["size"] >= least)
    return F.transform(long_enough, lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("order"), x["end"].alias("end")))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, row, base (structs start, order, end) and runs (start, end, run) for each row of docs, as a table."""
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for kind, pattern, group, _ in PATTERNS:
        text = text.withColumn(kind, _found(F.col("text"), pattern, group))
    text = text.withColumn("runs", _found(F.col("text"), RUN, 0))
    base = [_as_spans(kind, k, least) for k, (kind, _, _, least) in enumerate(PATTERNS)]
    runs = F.transform("runs", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["run"].alias("run")))
    made = text.select("doc_id", F.xxhash64("text").alias("text_hash"), F.array_sort(F.concat(*base)).alias("base"), runs.alias("runs"))
    return materialize(made.withColumn("row", F.monotonically_increasing_id()))


def _ln_tail(z: Column) -> Column:
    """The logarithm of the upper tail of a normal distribution; relative error a few per cent."""
    a = F.abs(z)
    ln = F.log(F.lit(0.5)) - 0.717 * a - 0.416 * a * a
    return F.when(z >= 0, ln).otherwise(F.log1p(-F.exp(ln)))


def tested(runs: DataFrame) -> DataFrame:
    """runs (run) with the columns class, bin and random_order: a length class, the binned p-value, whether the serial test passes."""
    one = runs.withColumn("letters", F.split("run", "")).withColumn("letters", F.filter("letters", lambda c: c != ""))
    one = one.withColumn("n", F.size("letters").cast("double"))
    k = d = None
    for _, pattern, letters, uneven in reversed(ENCODINGS):
        fits = F.col("run").rlike(pattern)
        k = F.lit(letters) if k is None else F.when(fits, letters).otherwise(k)
        d = F.lit(uneven) if d is None else F.when(fits, uneven).otherwise(d)
    one = one.withColumns({"k": k.cast("double"), "d": d})
    kind = lambda c: F.when(c.between("0", "9"), 0).when(c.between("a", "z"), 1).when(c.between("A", "Z"), 2).otherwise(3)
    one = one.withColumns({
        "squares": F.aggregate(F.array_distinct("letters"), F.lit(0.0), lambda s, c: s + F.pow(F.size(F.filter("letters", lambda x: x == c)).cast("double"), F.lit(2.0))),
        "kinds": F.transform("letters", kind),
        "codes": F.transform("letters", lambda c: F.ascii(c).cast("double")),
    })
    one = one.withColumns({
        "chi": F.col("k") / F.col("n") * F.col("squares") - F.col("n"),
        "changes": F.aggregate(F.zip_with(F.slice("kinds", 2, 1 << 30), F.slice("kinds", 1, 1 << 30), lambda a, b: F.coalesce(a, b) != b), F.lit(0.0), lambda s, x: s + x.cast("int")),
        "mean": F.aggregate("codes", F.lit(0.0), lambda s, x: s + x) / F.col("n"),
    })
    moment = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x - F.col("mean")) * (y - F.col("mean"))), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    one = one.withColumns({"together": moment(F.slice("codes", 2, 1 << 30), F.col("codes")), "spread": moment(F.col("codes"), F.col("codes"))})
    more = F.col("n") - 1
    expected = F.col("k") - 1 + more * F.col("d")
    chi_z = (expected - F.col("chi")) / F.sqrt(2 * (F.col("k") - 1) + 4 * more * F.col("d"))
    runs_z = (F.col("changes") - 0.5 - more * CHANGE_RATE) / F.sqrt(more * CHANGE_RATE * (1 - CHANGE_RATE))
    one = one.withColumn("half", -(_ln_tail(chi_z) + _ln_tail(runs_z)))
    ln_p = -F.col("half") + F.log1p("half")
    bin_ = F.least(F.lit(MOST_BIN), F.floor(-ln_p / F.log(F.lit(10.0)) * BINS_PER_DECADE)).cast("int")
    length_class = sum((F.col("n") >= x).cast("int") for x in LENGTH_CLASSES)
    serial = (F.col("spread") > 0) & (F.abs(F.col("together") / F.col("spread")) * F.sqrt("n") <= SERIAL_Z)
    made = {"class": F.when(F.col("run").rlike("[A-Za-z]"), length_class), "bin": bin_, "random_order": serial}
    return one.withColumns(made).select(*runs.columns, *made)


def discoveries(tests: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(class, least_bin): Benjamini-Hochberg's limit of each class of lengths; none where nothing passes."""
    by = tests.where("class is not null").groupBy("class", "bin").agg(F.count("*").alias("n"))
    group = Window.partitionBy("class")
    by = by.withColumns({"at_most": F.sum("n").over(group.orderBy(F.desc("bin"))), "all": F.sum("n").over(group)})
    passes = F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE) <= alpha * F.col("at_most") / F.col("all")
    return by.where(passes).groupBy("class").agg(F.min("bin").alias("least_bin"))


def secret_spans(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """doc_id, text_hash, base and spans for each row of docs: sorted arrays of structs (start, order, end); order is an index of KINDS."""
    rows = scanned(docs)
    runs = rows.select("row", F.explode_outer("runs").alias("r")).where("r is not null").select("row", "r.start", "r.end", "r.run")
    tests = materialize(tested(runs).drop("run"))
    limits = F.broadcast(discoveries(tests, alpha))  # a row for each of four classes
    kept = tests.join(limits, "class").where("random_order and bin >= least_bin")
    per = kept.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(len(PATTERNS)).alias("order"), "end")).alias("more"))
    out = rows.join(per, "row", "left")
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")
    return out.select("doc_id", "text_hash", "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"))


def rendered(spans: str) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["order"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["order"] == KINDS.index(kind))).cast("long")


def redact(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """docs, with all its columns, where every span of the text is replaced; overlapping spans make one replacement."""
    d, t, spans, own = free_names(docs, "span_id", "span_hash", "found_spans", "own_hash")
    found = secret_spans(docs, alpha).where(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias(d), F.col("text_hash").alias(t), F.col("spans").alias(spans)).dropDuplicates([d, t])
    found = guarded_broadcast(materialize(found))
    hashed = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    out = docs.withColumn(own, hashed)
    out = out.join(found, (F.col(own) == F.col(t)) & F.col("doc_id").eqNullSafe(F.col(d)), "left")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(F.col("text"), s["at"] + 1, F.greatest(F.lit(0), x["start"] - s["at"]))
        add = F.when((x["start"] >= s["at"]), F.concat(s["out"], F.array(gap, F.lit(REPLACEMENT)))).otherwise(s["out"])
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), add.alias("out"))

    rest = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col("text"), s["at"] + 1, F.lit(2**31 - 1)))
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.aggregate(spans, zero, step, rest))
    return out.withColumn("text", text).select(*columns_of(docs))
