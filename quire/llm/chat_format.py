"""Chat formatting: conversations that are prefixes of logged longer ones go, the rest is rendered.

A log that stores a conversation after every exchange holds each of its snapshots. A turn is its place
among the turns of its conversation, its role and its text. The rolling hash of a prefix is the
exclusive or of two 64-bit hashes of each of its turns, so that it is a running window
aggregate. A conversation goes if the hash of all its turns is that of a proper prefix of another
one (anti-join), or if it equals another conversation with a lesser conv_id.

A conversation may hold a third of all rows. Its turns are dealt to segments of SEGMENT turn numbers; one
exchange by conversation and segment carries the texts, all else is done on hashes: places and prefix hashes run within segments, and what
earlier segments add comes from a table of those conversations that have several. In the same stage up to SEGMENT turns in a row are
rendered, so nothing larger is gathered; turns that share a number stay in one segment, whose sort
spills. The rendering has a row for each such part; nearly every conversation has one. Turns
are in the order of turn, role and text.

Nulls and edges: a null conv_id is a conversation of its own; a null turn comes before all others;
a null role or text counts as empty in the rendering and as a value of its own in comparisons;
repeated rows are turns that repeat; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import guarded_broadcast, materialize

SEGMENT = 512
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _with(rows: DataFrame, more: DataFrame, *keys: str) -> DataFrame:
    """rows with the other columns of more, or nulls, by keys that may be null; more is small or its join shuffles."""
    named = guarded_broadcast(more.withColumnsRenamed({k: f"of_{k}" for k in keys}))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"of_{k}"))
    return rows.join(named, same, "left").drop(*[f"of_{k}" for k in keys])


def _before(order: Window, value: Column) -> Column:
    return F.coalesce(value.over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


def parts_of(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, segment, part, number, n_turns, text, turns), as a table: up to `segment` turns in a row.

    number counts the parts of a conversation from 0, n_turns its turns; turns has structs of place (from 1) and of the prefix hashes h1 and h2.
    """
    of = lambda df: df.withColumn("segment", F.coalesce(F.floor(F.col("turn") / segment), F.lit(-(2**62))).cast("long"))
    sizes = of(turns.select("conv_id", "turn")).groupBy("conv_id", "segment").agg(F.count("*").alias("size"))
    conversation = Window.partitionBy("conv_id")
    order = conversation.orderBy("segment")
    n_parts = F.ceil(F.col("size") / segment)
    sizes = sizes.withColumns({"parts": F.sum(n_parts).over(conversation), "before": _before(order, F.sum("size")), "earlier": _before(order, F.sum(n_parts)), "all": F.sum("size").over(conversation)})
    several = materialize(sizes.where("parts > 1").select("conv_id", "segment", "before", "earlier", "all"))

    rows = of(turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")))
    own = Window.partitionBy("conv_id", "segment").orderBy("turn", "role", "text")
    rows = _with(rows.withColumn("within", F.row_number().over(own)), several, "conv_id", "segment")
    rows = rows.withColumn("place", F.coalesce("before", F.lit(0)) + F.col("within"))
    missing = [F.col("role").isNull(), F.col("text").isNull()]
    rows = rows.withColumns({"x1": F.xxhash64("place", "role", "text", *missing), "x2": F.xxhash64(F.lit(1), "text", "role", "place", *missing)})
    said = F.concat(F.lit(BEGIN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(END), F.lit("\n"))
    running = own.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"h1": F.bit_xor("x1").over(running), "h2": F.bit_xor("x2").over(running), "said": said, "part": F.floor((F.col("within") - 1) / segment)})
    made = rows.groupBy("conv_id", "segment", "part").agg(F.array_sort(F.collect_list(F.struct("place", "h1", "h2", "said"))).alias("turns"), F.first("earlier").alias("earlier"), F.first("all").alias("all"))
    text = F.array_join(F.transform("turns", lambda x: x["said"]), "")
    hashes = F.transform("turns", lambda x: x.dropFields("said"))
    number, n_turns = F.coalesce("earlier", F.lit(0)) + F.col("part"), F.coalesce("all", F.size("turns").cast("long"))
    made = materialize(made.select("conv_id", "segment", "part", number.alias("number"), n_turns.alias("n_turns"), text.alias("text"), hashes.alias("turns"), F.col("all").isNotNull().alias("is_cut")))

    last = F.element_at("turns", -1)
    totals = made.where("is_cut").select("conv_id", "segment", "part", last["h1"].alias("t1"), last["h2"].alias("t2")).groupBy("conv_id", "segment").agg(F.max_by("t1", "part").alias("t1"), F.max_by("t2", "part").alias("t2"))
    totals = totals.select("conv_id", "segment", *[_before(order, F.bit_xor(f"t{k}")).alias(f"b{k}") for k in (1, 2)])
    out = _with(made, materialize(totals), "conv_id", "segment")
    moved = F.transform("turns", lambda x: F.struct(x["place"].alias("place"), *[x[f"h{k}"].bitwiseXOR(F.coalesce(f"b{k}", F.lit(0).cast("long"))).alias(f"h{k}") for k in (1, 2)]))
    return out.select("conv_id", "number", "n_turns", "text", moved.alias("turns"))


def collapsed(parts: DataFrame) -> DataFrame:
    """(conv_id, goes, n_copies), as a table: whether a conversation is a prefix of a longer one or equals one with a lesser conv_id."""
    each = parts.select("conv_id", "n_turns", F.explode("turns").alias("t")).select("conv_id", "n_turns", "t.*")
    last, keys = each.where("place = n_turns"), ["place", "h1", "h2"]
    ends = last.groupBy(*keys).agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id"))["conv_id"].alias("least"), F.count("*").alias("n_copies"))
    prefixes = each.where("place < n_turns").select(*keys).distinct().withColumn("inner", F.lit(True))
    ends = ends.join(prefixes, keys, "left")
    goes = F.col("inner").isNotNull() | ~F.col("conv_id").eqNullSafe(F.col("least"))
    return materialize(last.join(ends, keys).select("conv_id", goes.alias("goes"), "n_copies"))


def render(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, segment (from 0), n_turns, n_copies and text: the maximal conversations as training text.

    n_turns counts the whole conversation and n_copies the conversations equal to it, itself
    included. The segments of a conversation, joined in order, are its text.
    """
    parts = parts_of(turns, segment)
    judged = collapsed(parts)
    gone = guarded_broadcast(materialize(judged.where("goes").select(F.col("conv_id").alias("gone"))))
    kept = parts.join(gone, F.col("conv_id").eqNullSafe(F.col("gone")), "left_anti")
    out = _with(kept, materialize(judged.where("not goes and n_copies > 1").select("conv_id", "n_copies")), "conv_id")
    return out.select("conv_id", F.col("number").cast("int").alias("segment"), "n_turns", F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"), "text")
