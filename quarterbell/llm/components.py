"""Connected components of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbell.llm.tables import saved


def _least_of(edges: DataFrame) -> DataFrame:
    """node, least: the least of each node and its neighbours."""
    return edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node that can be reached) of each node of the links (a, b).

    Each round ties the neighbours of a node to the least of them: first those
    greater than the node, then those less. Both are joins with one row for each
    node, so nothing of a component is gathered in one place. Rounds grow with
    the logarithm of the nodes; they end when a round changes nothing.
    """
    edges = saved(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least_of(both), F.col("a") == F.col("node")).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = saved(large.where("a <> b").distinct(), "large-stars")  # a > b
        small = large.join(_least_of(large), F.col("a") == F.col("node"))
        edges = saved(
            small.select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(small.select("a", F.col("least").alias("b"))).where("a <> b").distinct(),
            "small-stars",
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return saved(nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), "components")
