"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.session import stage


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Smallest reachable node of each linked node; ``links`` has columns a and b, returns node and root.

    Large-star and small-star steps alternate: each links nodes to the least neighbour they see, until
    every component is a star around its least node. A step is an aggregation and a join on the links,
    written to the shared folder, so nothing is gathered and a lost executor costs one step at most.
    Nodes without links are not returned; links of a node with itself are ignored.
    """

    def stars(rows: DataFrame) -> tuple[DataFrame, tuple]:
        kept = stage(spark, rows.where("a <> b").distinct())
        return kept, tuple(kept.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now, seen = stars(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while seen[0]:
        near = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = near.join(least, "u").where("v > u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v")
        large = stage(spark, large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now, found = stars(small)
        if found == seen:
            break
        seen = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
