"""Connected components of a table of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.session import stage


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``links`` (columns ``u``, ``v``): the smallest id
    that it reaches. Each step replaces a node's links by links to its smallest neighbour
    and is written to the shared folder; a node's neighbours are pre-aggregated to their
    minimum, never gathered. Ends when a step changes nothing. Loops and repeated links
    do no harm; no links give an empty table."""
    now = stage(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        # large star: neighbours above a node move to the smallest of its neighbourhood
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "links")
        # small star: a node and its neighbours below it move to the smallest of them
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    top = now.groupBy("u").agg(F.min("v").alias("component"))
    return top.withColumnRenamed("u", "id").unionByName(
        now.select("v").distinct().join(top, F.col("v") == F.col("u"), "left_anti").select(F.col("v").alias("id"), F.col("v").alias("component"))
    )
