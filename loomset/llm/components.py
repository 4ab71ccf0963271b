"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every greater neighbour of a node to the least of its neighbourhood."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Tie a node and its lesser neighbours to the least of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("u", "m")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node that has links, roots (the least nodes) included.

    ``links`` has two comparable columns. Each round is written to the shared
    scratch folder; rounds grow with the logarithm of a component's size. Hubs
    are summed up before shuffles, and Spark splits skewed joins on them.
    """
    now = written(links.toDF("a", "b").filter("a != b").distinct(), "links")
    mark = None
    while True:
        now = written(_small_star(_large_star(now)), "links")
        new = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if new == mark:
            break
        mark = new
    ties = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return ties.union(ties.select(F.col("root").alias("node"), "root").distinct())
