"""Connected components as rounds of star contraction, each round a saved table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import dropped, saved

LINKS = 20_000  # links per task at least; tables of few links are not dealt over all partitions of the session


def digest(links: DataFrame) -> tuple:
    """Number of links and sum of their ends.

    A round never adds links, and one that loses none makes an end smaller with every change. So it has
    changed nothing if both are as before.
    """
    ends = F.col("a").cast("decimal(20,0)") + F.col("b").cast("decimal(20,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(ends)).first())


def contracted(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the component's smallest node.

    Alternating large and small stars: each round links the neighbours of a node to the smallest
    of them, first the larger ones, then the others. A round's links are fewer or nearer to a
    root, and the number of rounds grows with the logarithm of the component. A node with very
    many neighbours is met by aggregation and an equi-join, never collected.
    """
    links = saved(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "star")
    before = digest(links)
    while True:
        tasks = 2 + before[0] // LINKS
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(large.coalesce(tasks), "star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
        small = large.join(low, "a").select(F.inline(ends)).filter("a <> b").coalesce(tasks).distinct()
        small = saved(small.coalesce(tasks), "star")
        after = digest(small)
        dropped(links)
        dropped(large)
        links, ended = small, after == before
        before = after
        if ended:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def smallest_reachable(nodes: DataFrame, pairs: DataFrame, node: str, value: str) -> DataFrame:
    """(node, value): the smallest value in each node's component; unlinked nodes keep their own."""
    roots = contracted(pairs)
    root = F.coalesce("root", F.col(node))
    placed = nodes.join(roots.withColumnRenamed("node", node), node, "left").withColumn("root", root)
    least = placed.groupBy("root").agg(F.min(value).alias(value))
    return placed.drop(value).join(least, "root").select(node, value)
