"""Connected components by alternating large-star and small-star steps.

Every step is a join and an aggregation over the links, written to the shared
folder; links are never brought together in one task or on the driver, and a
node with very many links is split by the join (its minimum is pre-aggregated).
The number of steps grows with the logarithm of the longest shortest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select("v", "u"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of ``links`` with the smallest node it
    reaches.  Self links, repeated links and either direction are allowed; null
    ends are not links; no links give an empty table."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e, before = written(e, "links"), None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before, e = now, written(_small_star(_large_star(e)), "links")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
