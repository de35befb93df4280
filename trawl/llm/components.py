"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round over links ``(u, v)``: neighbours of ``u`` are tied to the least one.

    Large: every greater neighbour ``v`` of ``u`` is tied to the least node
    around ``u``. Small: the lesser neighbours and ``u`` itself are tied to it.
    The least node is a partial aggregate, so a hub is reduced map-side; the
    join on ``u`` that follows can be split by adaptive execution.
    """
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        tied = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        others = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tied = others.unionByName(least.select("u", F.col("m").alias("v")))
    return tied.where("u <> v").distinct()


def _digest(links: DataFrame) -> tuple:
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(h)).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of links ``(u, v)`` that isn't the root itself.

    The root is the least node of the component. Rounds repeat until the links
    stay the same; each round's links are written out, so lost executors cost
    one round at most. Links of a node to itself are ignored; an empty table
    gives no rows.
    """
    now = materialize(links.select("u", "v").where("u <> v").distinct(), "links")
    seen = _digest(now)
    while True:
        now = materialize(_star(_star(now, large=True), large=False), "links")
        digest = _digest(now)
        if digest == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = digest
