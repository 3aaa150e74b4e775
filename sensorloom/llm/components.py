"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b), where the label is the component's least node.

    Each round hangs every node's larger neighbours, then its smaller ones, below its least
    neighbour, until every node hangs below the least of its component.  A node with very many
    neighbours is only reduced to a minimum and joined; nothing is gathered.
    """
    edges = stored(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionAll(lower.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
