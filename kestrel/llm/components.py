"""Connected components of a graph of links, as DataFrame joins.

Alternating large-star and small-star steps: every node hangs its larger
neighbours, then its smaller ones, under the smallest node it knows. The number of
links never grows, and a chain of n links is gone after about log n rounds. Each
round is written to the shared folder, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that a link joins to a smaller one; ``root`` is its component's smallest node.

    Links may be repeated, reversed or from a node to itself; no link gives no rows.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = staged(links.where(F.col(a) != F.col(b)).select(u, v).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
