"""Connected components by alternating star contractions, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import discard, materialize

#: A node with more edges than this, and than edges / MOST_HUBS, meets its minimum by a broadcast: at most 2 * MOST_HUBS nodes.
HUB, MOST_HUBS = 256, 500_000


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(rows: DataFrame, least: DataFrame, n_edges: int) -> DataFrame:
    """rows (a, b) with the m of their a from least (a, m, n), where n counts the rows of a; hubs are never dealt by their key."""
    limit = max(HUB, n_edges // MOST_HUBS)
    hubs = least.where(F.col("n") > limit).select("a", F.col("m").alias("of_hub"))
    both = rows.join(F.broadcast(hubs), "a", "left")
    few = both.where("of_hub is null").select("a", "b").join(least.where(F.col("n") <= limit).select("a", "m"), "a")
    return few.select("a", "b", "m").union(both.where("of_hub is not null").select("a", "b", F.col("of_hub").alias("m")))


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Each larger neighbour of a node is tied to the least of the node and its neighbours."""
    nbr = _both_ways(edges)
    least = nbr.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
    return _with_least(nbr.where("b > a"), least, n_edges).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    tied = _with_least(down, least, n_edges).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> (node long, root long), root the least node reachable.

    Only nodes that have an edge to another node appear. Every round writes its edges to the
    shared folder and deletes those of the round before; the number of rounds grows with the logarithm of the number of nodes.
    No component is ever gathered: a round keeps one row for each edge, minima are taken before the
    shuffle, and the edges of hubs meet their minimum where they are.
    """
    now = materialize(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct())
    seen, n_edges = None, now.count()
    while True:
        large = materialize(_large_star(now, n_edges).distinct(), replaces=now)
        now = materialize(_small_star(large, n_edges).distinct())
        discard(large)
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen:
            break
        seen, n_edges = state, state[0]
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
