"""Connected components by star contraction, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driverlens.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """From links (u, v): each linked node and its component's smallest node.

    Every round first hangs a node's larger neighbours, then its smaller ones, on its smallest
    neighbour, until all links point at the smallest node of their component. The number of
    rounds grows with the logarithm of the longest path. Repeated links, self-links and an empty
    table are fine; a node without links has no row. Each round is a table in the shared folder.
    """
    here = materialize(_down(edges.select("u", "v")), "links")
    before = None
    while (now := _measure(here)) != before:
        before = now
        both = here.union(here.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        hung = materialize(_down(large), "links")
        low = hung.groupBy("u").agg(F.min("v").alias("low"))
        small = hung.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        here = materialize(_down(small.union(low.select("u", F.col("low").alias("v")))), "links")
    named = here.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return named.union(here.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _down(edges: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller node."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _measure(edges: DataFrame) -> tuple:
    """Number of links and of their lower ends, and a sum that falls with every move."""
    return tuple(edges.agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first())
