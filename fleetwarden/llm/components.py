"""Connected components of a graph given as pairs, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.common import stored
from fleetwarden.operators.lookup import look_up


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    tied = look_up(both, least, ["u"]).withColumn("m", F.least("m", "u"))
    return tied.filter("v > u and v <> m").select(F.col("v").alias("b"), F.col("m").alias("a"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of these."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    tied = look_up(edges, least, ["b"])
    lower = tied.filter("a <> m").select(F.col("a").alias("b"), F.col("m").alias("a"))
    return lower.unionByName(least.select("b", F.col("m").alias("a")))


def components(pairs: DataFrame) -> DataFrame:
    """(id, component) for the ids of ``pairs`` (a, b): the least id reachable, itself included.

    Each round shortens every path; the work and the joins are in proportion to the pairs that are
    left, and a node with very many neighbours is split like any frequent key. Pairs with NULL or
    two equal ids are left out. Each round is written to the shared folder.
    """
    edges = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stored(edges.distinct(), "edges")
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("h")).first()
        if now == seen:
            break
        seen = now
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "edges")
    roots = edges.select(F.col("a").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(roots)
