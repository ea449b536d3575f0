"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than a node are tied to the smallest node it sees."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    tied = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    tied = down.join(least, F.col("a") == F.col("u")).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("u", "m")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that it reaches, for every node with an edge.

    ``edges`` has two columns of one orderable type. Alternating large and small stars ends in one star
    for each component after a number of rounds that grows with the logarithm of the nodes. A round
    groups with partial aggregation and joins the groups' minima back, so that a node with very many
    neighbours is split by the skew join. Each round is a written table. Loops, doubled edges and edges
    with a null end do no harm; the latter link nothing.
    """
    a, b = edges.columns
    current = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct(), "edges")
    before, now = None, _state(current)
    while now != before:
        current = stored(_small_star(_large_star(current)), "stars")
        before, now = now, _state(current)
    roots = current.select("b").distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("b", "b"))
