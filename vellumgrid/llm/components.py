"""Connected components of a graph of links, by rounds of large-star and small-star joins.

Both steps keep the components and bring each node's links towards its smallest
neighbour; a graph that neither changes is a set of stars around the smallest ids. Links
never leave the executors: each round is written to the shared folder, and only its
row count and a checksum come to the driver.

A node of many links is divided in the joins: its links go to SHARES keys, and as nothing
else is done by key in those tasks, Spark can divide them further.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

SHARES = 4


def _beside(links: DataFrame, least: DataFrame) -> DataFrame:
    """(v, m) for each of ``links`` (u, v), with m from ``least`` (u, m)."""
    spread = least.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return links.withColumn("share", F.pmod(F.xxhash64("v"), F.lit(SHARES)).cast("int")).join(spread, ["u", "share"]).select("v", "m")


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id that has a link; component is the smallest id reachable.

    Links of an id to itself and links with a null end are ignored.
    """
    now = scratch.keep(links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("u <> v").distinct(), "links")
    mark = None
    while True:
        # large-star: every larger neighbour of u is linked to u's smallest neighbour
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _beside(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small-star: u and its smaller neighbours are linked to the smallest of them
        down = large.where("u <> v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = _beside(down, low).select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        after = scratch.keep(small.where("u <> v").distinct(), "links")
        row = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        scratch.drop(now)
        now = after
        if (row["n"], row["h"]) == mark:
            break
        mark = row["n"], row["h"]
    heads = now.groupBy("v").agg(F.count("*").alias("n")).select(F.col("v").alias("id"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(heads)
