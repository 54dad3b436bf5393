"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.scratch import drop, written


def _with_smallest(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with m, the smallest of u and all of its v."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(smallest, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    found = _with_smallest(edges)
    ends = found.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return ends.where("u != v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """For undirected edges (u, v): each node that isn't the smallest of its component, and that smallest node, as (u, v).

    Loops and repeated edges change nothing; rows with a NULL end are ignored.
    Each half of a round is written, so a lost executor costs one at most and no
    plan holds both. The edges of a hub are joined to its minimum, never gathered
    in one row.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u") != F.col("v")).alias("_links"))
    now = written(now.where("_links").select("u", "v").distinct(), "edges")
    state = None
    while True:
        large = written(_large_star(now), "edges")
        drop(now)
        now = written(_small_star(large), "edges")
        drop(large)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == state:
            return now
        state = mark
