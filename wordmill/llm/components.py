"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step replaces a node's edges by edges to the smallest node it sees; the table never grows
beyond two rows per edge, a node's neighbours are aggregated map-side, and the number of rounds
follows the logarithm of the longest path. Every round is staged, so that lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges ``(a, b)``, a > b. Large: larger neighbours of each node to its smallest. Small: the rest."""
    if large:
        seen = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges
    least = seen.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    out = seen.join(least, "a")
    if large:
        out = out.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return out.filter("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mixed).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest node reached."""
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges)
    before = _state(edges)
    while True:
        edges = stage(_star(_star(edges, large=True), large=False))
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
