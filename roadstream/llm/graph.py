"""Connected components by alternating stars, in tables of the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import written


def _smallest(edges: DataFrame) -> DataFrame:
    """Each node with its smallest neighbour, itself included."""
    return edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("least"))


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node and component (its smallest reachable node) of every node of the edges (a, b), whatever their type.

    Large star and small star take turns: each edge is replaced by edges to the smallest neighbour, until every node has one
    edge, to its component. The number of rounds grows with the logarithm of the longest path. Edges never grow in number.
    Loops and repeated edges are allowed; no edges give no rows.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_smallest(both), F.col("a") == F.col("node")).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.distinct()
        stars = large.join(_smallest(large), F.col("a") == F.col("node"))
        small = stars.select(F.explode(F.array(F.struct(F.col("a"), F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e")).select("e.a", "e.b")
        after = written(small.filter("a <> b").distinct(), "stars")
        # Done when every node has one edge and no target has an edge of its own.
        nodes = after.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        open_nodes = nodes.filter("n > 1").limit(1).count() + after.select("b").join(after.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        edges = after
        if not open_nodes:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
