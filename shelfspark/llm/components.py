"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import stored


def _both(edges: DataFrame) -> DataFrame:
    """Each edge in both directions."""
    pair = F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")),
                   F.struct(F.col("v").alias("a"), F.col("u").alias("b")))
    return edges.select(F.explode(pair).alias("e")).select("e.a", "e.b")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node of its neighbourhood."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (near.filter(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").select(F.explode(F.array("a", "b")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """Node and component (its smallest reachable node) for the nodes of ``edges`` (u, v).

    Each round is written to the shared folder, which cuts the lineage; rounds stop when the
    edges no longer change, that is, when they are stars around the smallest nodes. Neighbour
    lists are never gathered: minima are aggregated and joined back.
    """
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges")
    before = _state(edges)
    while before["n"]:
        edges = stored(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    return (edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
