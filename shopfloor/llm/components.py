"""Connected components of a table of links, by joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.text import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or smaller) neighbours to the smallest of it and its neighbours."""
    if large:
        edges = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        out = edges.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
        out = edges.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            lowest.select("a", F.col("low").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node it reaches) of every node that has a link.

    ``links`` has the columns a and b of one type. Alternates stars until nothing changes: about as
    many rounds as the logarithm of the longest path. Per round the driver gets two numbers."""
    edges, before = links.select("a", "b").where("a <> b").distinct(), None
    while True:
        edges = saved(_star(_star(edges, large=True), large=False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
