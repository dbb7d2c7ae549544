"""Connected components of a graph by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node reachable by contraction.

    Each round every node joins its smallest neighbour if that is smaller, and edges
    are drawn anew between what nodes have joined; edges inside one are gone. Every
    node that keeps an edge and is no local minimum disappears, so at least half of
    them do, and the rounds grow with the logarithm of the nodes. Tables of a round
    are written, which cuts the lineage.
    """
    edges = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = written(nodes.select("node", F.col("node").alias("root")), "roots")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        # most nodes stay in place; only moves are joined
        moves = both.groupBy("a").agg(F.min("b").alias("to")).filter("to < a").withColumnRenamed("a", "was")
        moves = written(moves, "moves")
        roots = written(
            roots.join(moves, F.col("root") == F.col("was"), "left").select("node", F.coalesce("to", "root").alias("root")),
            "roots",
        )
        half = edges.join(moves, F.col("a") == F.col("was"), "left").select(F.coalesce("to", "a").alias("a"), "b")
        drawn = half.join(moves, F.col("b") == F.col("was"), "left").select("a", F.coalesce("to", "b").alias("b"))
        edges = written(drawn.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return roots
