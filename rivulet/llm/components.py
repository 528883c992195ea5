"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rivulet.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(low, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them. Edges point from large to small."""
    low = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    joined = edges.join(low, F.col("a") == F.col("u"))
    moved = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """`node`, `component` (its smallest node) for every node that has an edge to another one.

    Edges are undirected pairs of one orderable type; loops, repeated edges
    and edges with a null end are ignored. Rounds of large-star and small-star
    steps end in one star per component. A star's centre may touch a third of
    all edges: minima are combined before they move, and the joins are plain
    shuffled joins, which Spark splits where one key is heavy. Every round is
    written to the shared folder, so a lost executor costs one round.
    """
    pairs = edges.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
    current = stored(pairs.where(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col(first) != F.col(second))).distinct())
    state = _state(current)
    while state[0]:
        current = stored(_small_star(_large_star(current)))
        after = _state(current)
        if after == state:
            break
        state = after
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)
