"""Connected components of a table of links, without a pass over all of it in one place.

Large-star and small-star steps in turn: every step is a map-side combined minimum per node and an equi-join, so a node
with millions of links is spread by the adaptive skew join. Each step's links are written to the shared folder, so lost
executors cost one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridlens.llm.common import stored


def _least(directed: DataFrame) -> DataFrame:
    """u, m: the smallest of u and its neighbours v."""
    return directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    return both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).filter("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``links`` (two columns of longs, no nulls)."""
    def size(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    now = stored(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "links")
    seen = size(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now)), "links")
        last, seen = seen, size(now)
        if last == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v"), F.col("v")).distinct())


def joined_components(first: DataFrame, met: DataFrame) -> DataFrame:
    """node, component of ``first`` after its components are joined by ``met`` (c1, c2: components, or nodes without one)."""
    second = components(met.select("c1", "c2").distinct(), "c1", "c2").select(
        F.col("node").alias("c1"), F.col("component").alias("joined"))
    ends = second.join(first.select(F.col("component").alias("c1")).distinct(), "c1", "left_anti")
    lone = ends.select(F.col("c1").alias("node"), F.col("joined").alias("component"))
    grown = first.withColumnRenamed("component", "c1").join(second, "c1", "left").select(
        "node", F.coalesce("joined", "c1").alias("component"))
    return grown.union(lone)
