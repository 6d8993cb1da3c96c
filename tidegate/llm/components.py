"""Connected components by alternating stars.

Each round points every node at its smallest neighbour, first from larger neighbours, then from
smaller ones, with one partial aggregation and one join each: a node of many links is a join key
of many rows, which adaptive execution splits, and never a list in one task. The number of links
never grows; a round is written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.session import stored


def _signature(links: DataFrame):
    return links.agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"),
                                                          F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v): every linked node that is not the smallest of its component, and that smallest.

    ``links`` has two long columns ``a`` and ``b``; loops and repeated links do no harm.
    """
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                              F.least("a", "b").alias("v")).distinct(), "links")
    before, signature = None, _signature(now)
    while signature != before:
        now = stored(_small_star(_large_star(now)), "links")
        before, signature = signature, _signature(now)
    return now
