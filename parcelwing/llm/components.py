"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwing.llm.common import stored


def connected(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex of edges(a, b); a component is named by its smallest vertex.

    Each step re-hangs the neighbours of a vertex under the smallest of them, so
    a vertex with a third of all edges only feeds a minimum, which is combined
    before the shuffle, and an equi join that adaptive execution can split. The
    edges are stored after every round; rounds grow with the logarithm of the
    longest path. Null ends and loops are left out.
    """
    turned = edges.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, seen = stored(turned.distinct(), "edges"), None
    while True:
        print_ = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        if print_ == seen or print_[0] == 0:
            return current.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(
                current.select("b", "b").distinct())
        seen = print_
        current = stored(_small_star(_large_star(current)), "edges")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    hung = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", "m")).distinct()
