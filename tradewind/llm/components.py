"""Connected components of an edge table by alternating stars.

Each round hangs larger neighbours on the smallest one (large star), then smaller ones
(small star), until the edges form stars. Minima are pre-aggregated and written before
they are joined back, so a node with very many edges is split like any skewed join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.frames import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _hang(edges: DataFrame, least: DataFrame) -> DataFrame:
    """(a, b) becomes (b, least of a)."""
    least = stored(least, "least")
    return (edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges(a, b)`, root the smallest node reachable.
    Loops and repeated edges change nothing; no edges give no rows."""
    edges = stored(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        larger = both.filter("b > a")
        edges = stored(_hang(larger, least), "large")
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        edges = stored(_hang(edges, least).union(
            least.select("a", F.col("m").alias("b"))).distinct(), "small")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
