"""Connected components by alternating star contractions; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _print_of(edges: DataFrame) -> tuple:
    # A decimal sum of hashes cannot overflow.
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u, v): root is the smallest node of its component.

    Large stars hang each node's larger neighbours on its smallest one, small stars its smaller ones, until
    nothing changes; the number of rounds grows with the logarithm of the longest chain. Hub nodes are read
    through joins that Spark can split, and minima are partially aggregated before they are shuffled. A round's
    table goes when the next one is written.
    """
    held = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    before = None
    while (now := _print_of(held.df)) != before:
        before, edges = now, held.df
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, held = held, written(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        last.drop()
    roots = held.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(held.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
