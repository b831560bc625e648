"""Connected components of a link table by alternating large and small stars.

Every step is a grouped minimum and a join, so no list of neighbours is ever
collected; a node with very many links is pre-aggregated and its join is one that
Spark can split.  Only one row of totals per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with a link: the smallest node it reaches.

    ``links`` are undirected pairs of longs; loops, nulls and repeats do no harm.
    Nodes without a link are not returned.
    """
    edges = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = edges.filter("a is not null and b is not null and a != b").distinct()
    before = None
    while True:
        edges = saved(_small_star(_large_star(edges)).distinct())
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if before == now:
            found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return found.union(edges.select("b", "b").distinct())
        before = now
