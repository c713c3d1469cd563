"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epicentre.llm.common import written


def _linked(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: a node's larger neighbours go to its least neighbour.  Small star: its smaller ones and itself do.

    Both need only the least neighbour of each node, a pre-aggregated minimum, so that a node
    with very many neighbours is never gathered in one place.
    """
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = near.join(least, "u")
    if large:
        out = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least reachable node) for every node of ``edges`` (u, v).

    Each round is written and read back; the rounds grow with the logarithm of the longest
    path, not with the number of edges.
    """
    now = written(edges.select("u", "v").where(F.col("u") != F.col("v")), "components-edges")
    state = None
    while True:
        now = written(_linked(now, True), "components-large")
        now = written(_linked(now, False), "components-small")
        s = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if s == state or not s[0]:
            break
        state = s
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
