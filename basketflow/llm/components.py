"""Connected components of a graph given as edges, with every step a join or an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.base import stored

#: Edges for each task. A graph is most often much smaller than the table it comes from.
EDGES_PER_TASK = 100_000


def _sized(df: DataFrame, edges: int) -> DataFrame:
    """No more tasks than the edges need; never more than the shuffle before has."""
    return df.coalesce(max(1, -(-edges // EDGES_PER_TASK)))


def _stars(edges: DataFrame, n: int) -> DataFrame:
    """One round: every node hands the smallest of its neighbours to the larger ones, then to the smaller."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Stored, so that the join has two plain shuffles and the edges of a hub can be split.
    least = stored(_sized(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), n), "least")
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    large = stored(_sized(large, n), "large-stars")
    # Now each edge points from the larger node to the smaller.
    least = stored(_sized(large.groupBy("a").agg(F.min("b").alias("m")), n), "least")
    small = _sized(large.join(least, "a"), n).select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
    return _sized(small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).filter("a <> b").distinct(), n)


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` rows to ``(node, root)``: each node with an edge, and the smallest node it is joined to.

    Rounds of alternating stars halve the distances to the root; each is stored in the shared folder, and
    only counts reach the driver. It ends when each node has one edge, to a node that has none of its own.
    """
    now = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    while True:
        sides = now.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("own")), F.struct(F.col("b").alias("n"), F.lit(0).alias("own")))).alias("s"))
        each = sides.groupBy("s.n").agg(F.sum("s.own").alias("own"), F.min("s.own").alias("least"))
        n, open_nodes = each.agg(F.coalesce(F.sum("own"), F.lit(0)), F.count_if(F.expr("own > 1 or (own = 1 and least = 0)"))).first()
        if not open_nodes:
            break
        now = stored(_stars(now, n), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
