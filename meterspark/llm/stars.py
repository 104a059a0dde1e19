"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterspark.llm.storage import sized


def star_components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in `links` (a, b): label is the smallest node that links reach.

    Each edge is kept once, as (child, parent) with parent < child. A large-star step hangs every
    node's larger neighbours on the least of its neighbourhood, a small-star step the smaller ones
    and the node itself. Both keep components as they are and lower parents; edges never become more.
    They end as one star per component, whose centre is its smallest node. Steps are joins with one
    row per node, so a node with very many neighbours is a key that adaptive execution can split;
    only whether any edge still lies off a star reaches the driver. Edges are written as a table after each
    step, so that the next one reads them by their size: a few edges in many files make few tasks. Links of a node with itself, and
    those with a null end, say nothing. Nodes are of any type that can be ordered.
    """
    edges = sized(_directed(links, F.col("a"), F.col("b")), "edges")
    while not _stars(edges):
        edges = sized(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("child").alias("node"), F.col("parent").alias("label")).unionByName(
        edges.select(F.col("parent").alias("node"), F.col("parent").alias("label")).distinct())


def _directed(pairs: DataFrame, a: Column, b: Column) -> DataFrame:
    return pairs.filter(a != b).select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """One row per edge at most, and not made distinct: the small-star step does that."""
    both = edges.select(F.col("child").alias("u"), F.col("parent").alias("v")).unionByName(
        edges.select(F.col("parent").alias("u"), F.col("child").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("child"), F.col("m").alias("parent"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("child").agg(F.min("parent").alias("m"))
    hung = edges.join(least, "child").select(F.col("parent").alias("v"), "m").unionByName(
        least.select(F.col("child").alias("v"), "m"))
    return _directed(hung, F.col("v"), F.col("m"))


def _stars(edges: DataFrame) -> bool:
    """Whether every child has one parent, and no parent is a child. Edges are distinct."""
    ends = edges.select(F.col("child").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")).unionByName(
        edges.select("parent", F.lit(0), F.lit(1)).toDF("node", "above", "below"))
    return ends.groupBy("node").agg(F.sum("above").alias("above"), F.max("below").alias("below")).filter(
        "above > 1 or above = 1 and below = 1").isEmpty()
