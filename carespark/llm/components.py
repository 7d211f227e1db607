"""Connected components by alternating large and small stars, each round written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node's larger neighbours (or its smaller ones and itself) moved to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = both.union(edges.select("b", "a"))
    else:  # every edge seen from its larger end
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = saved(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")), "star")
    moved = both.join(low, "u")
    out = moved.where(F.col("v") > F.col("u")) if larger else moved
    out = out.select(F.col("v").alias("a"), F.col("low").alias("b"))
    if not larger:
        out = out.union(low.select("u", "low"))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node in links (a, b).

    The number of rounds grows with the logarithm of the links; a hot node is
    only ever joined with its one smallest neighbour.
    """
    edges = links.select("a", "b").where(F.col("a") != F.col("b")).distinct()
    before = None
    while True:
        edges = saved(_star(saved(_star(edges, True), "stars"), False), "stars")
        now = _state(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct())
        before = now
