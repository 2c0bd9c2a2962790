"""Connected components by alternating large and small stars, in tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def components(work: Workspace, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the root is the component's smallest node.

    The number of rounds grows with the logarithm of a component's size. Minima are
    aggregated before the shuffle, and the joins read stored tables, so that adaptive
    execution can split a hub. No edges give no rows.
    """
    now = work.stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = work.stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = work.stored(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "edges")
        least = work.stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        now = work.stored(small.select("e.*").filter("a <> b").distinct(), "edges")
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return work.stored(now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots), "components")


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to its root, and no root has one of its own."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(edges.select("b", F.lit(0), F.lit(1)))
    wrong = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")).filter("below + above > 1")
    return not wrong.limit(1).count()
