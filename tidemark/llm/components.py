"""Connected components by alternating large and small stars, as joins and aggregates.

Each round links every node's larger (then smaller) neighbours to its smallest one, until
only stars are left: a few rounds for groups of copies, whatever their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a > b). The smallest neighbour of a node comes from a map-side aggregate."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u").where("v > u" if large else "v <> m").select(F.col("v").alias("x"), "m")
    if not large:
        linked = linked.unionByName(least.select(F.col("u").alias("x"), "m"))
    return linked.where("x <> m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node of ``edges`` (a > b) has one smaller neighbour at most, and that one none:
    then the neighbour is the smallest of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    return ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high")).where("low + high > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node it reaches."""
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(ordered, "links")
    while not _settled(edges):
        edges = stored(_stars(_stars(edges, True), False), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
