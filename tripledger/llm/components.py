"""Connected components of an undirected graph, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.tables import store


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge in (a, b); the component is its smallest node.

    Alternating large and small stars: each round ties neighbours to the smallest node around, until
    all nodes hang on their component's smallest. Every round is stored in the shared folder; the
    driver sees two numbers a round. A node with very many edges is a skewed key of a join. Its minimum
    is taken before the shuffle, and the join has null-safe keys, so that both sides are shuffled for it
    alone and Spark can split the node's edges. Null ends and loops are left out.
    """
    lower, higher = F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")
    current = store(edges.where("a <> b").select(higher, lower).distinct(), "edges")
    seen = None
    while (now := _sign(current)) != seen:
        seen = now
        current = store(_small_star(_large_star(current)), "edges")
    roots = current.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _sign(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties all larger neighbours of a node to the smallest node around it."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # An edge's larger end is tied to the smallest node around its smaller end.
    around = least.select(F.col("u").alias("_v"), "m")
    return edges.join(around, F.col("v").eqNullSafe(F.col("_v"))).select("u", F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    around = least.withColumnRenamed("u", "_u")
    tied = edges.join(around, F.col("u").eqNullSafe(F.col("_u"))).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
