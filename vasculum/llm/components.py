"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vasculum.llm.storage import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the least of them. Edges go from the larger to the smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    """Count and hash sum of the edges: two numbers, whatever the size."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node of `edges` (a, b: long), component being its smallest reachable node.

    Loops, repeated edges and nulls are ignored; no edges give no rows. Every round halves
    the distances at least, so the rounds grow with the logarithm of the longest chain. A hub is
    met only by per-key minima with map-side combining, and by joins whose other side has
    one row for a key, which adaptive execution can split. Raises if the rounds do not suffice.
    """
    edges = (
        edges.filter("a <> b")
        .select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
        .distinct()
    )
    edges = stored(edges, "edges")
    digest = _digest(edges)
    for _ in range(most_rounds):
        edges = stored(_small_star(_large_star(edges)), "edges")
        before, digest = digest, _digest(edges)
        if digest == before:
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                roots.withColumn("component", F.col("node"))
            )
    raise RuntimeError(f"components have not settled after {most_rounds} rounds")
