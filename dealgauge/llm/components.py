"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dealgauge.llm.scratch import Scratch


def connected_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node and component (the smallest node reachable) of every node of `links` (a, b).

    Each step is an aggregate by node with a minimum, so a node with very many links is pre-aggregated, and a join
    that Spark can split. Steps go on until nothing changes; the stars that are left are the components."""
    current = scratch.write(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), f"{name}0")
    step, before = 0, None
    while True:
        step += 1
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: what a node points to points to the smallest of it
        lower = large.filter("a <> b").distinct()
        small = lower.groupBy("a").agg(F.min("b").alias("m"))
        joined = lower.join(small, "a")
        new = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(
            joined.select("a", F.col("m").alias("b"))).distinct()
        new = scratch.write(new, f"{name}{step}")
        scratch.drop(f"{name}{step - 1}")
        mark = new.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if before == mark:
            break
        before, current = mark, new
    roots = new.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return new.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
