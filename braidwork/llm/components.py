"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidwork.llm.common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(least.withColumnRenamed("a", "u"), F.col("a") == F.col("u")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionAll(rest).distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every linked node; the root is the smallest of the component.

    Each round is written to the shared folder; the rounds needed grow with the logarithm
    of the largest component.
    """
    current = materialise(links.filter("a <> b").select("a", "b"), "links")
    before = None
    for _ in range(max_rounds):
        current = materialise(_small_star(_large_star(current)), "stars")
        state = tuple(current.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
