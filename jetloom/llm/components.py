"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    both = _both_ways(links)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("top"), F.least("u", "v").alias("low"))
    least = down.groupBy("top").agg(F.min("low").alias("m"))
    moved = down.join(least, "top").where("low > m").select(F.col("m").alias("u"), F.col("low").alias("v"))
    return moved.unionAll(least.select(F.col("m").alias("u"), F.col("top").alias("v"))).distinct()


def stars(links: DataFrame) -> DataFrame:
    """node, root of every node of ``links`` (u, v), where root is the smallest node of its component and not the node itself; also root, root.

    Large-star and small-star rounds in turn, each written to the shared folder, until a
    round changes nothing. No list of neighbours is gathered: both steps are a minimum
    per node and a join.
    """
    links = written(links.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links", few_files=True)
    state = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    now = state(links)
    while now[0]:
        links = written(_small_star(_large_star(links)), "links", few_files=True)
        before, now = now, state(links)
        if now == before:
            break
    tops = links.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return tops.unionAll(links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
