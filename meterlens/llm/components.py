"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(pairs: DataFrame) -> DataFrame:
    """Smallest of each a and its partners; combined before the shuffle."""
    return pairs.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for the nodes of links (a, b), two columns of one type.

    A component is named by its smallest node. Large-star and small-star steps by turns
    (each links nodes to the smallest neighbour) until every node points at its
    component. A step is an aggregate and a join on the node, so a node with very many
    links is combined in the map tasks and split as a skewed join; each step's links
    are written to the shared folder. No links give no rows; loops are ignored.
    """
    links = stored(edges.select("a", "b").filter("a <> b"), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    before = None
    while True:
        pairs = _both_ways(links)
        large = (
            pairs.join(_least(pairs), "a").filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        )
        large = stored(large, "links")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = _least(down)
        small = (
            down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .filter("a <> b").distinct()
        )
        links = stored(small, "links")
        now = links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
