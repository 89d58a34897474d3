"""Connected components of a graph of links, in Spark (alternating stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.spark import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component``: for every node of ``links`` the smallest node it is connected to.

    Nodes are hung onto the smallest neighbour in turns of large stars (nodes above)
    and small stars (nodes below) until nothing changes; a hub's neighbours meet
    only its minimum, which is aggregated before the shuffle, so the work of a
    turn grows with the links.  Links with a null end or from a node to itself
    are ignored.
    """
    e = cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (F.col(a) != F.col(b)).alias("ok")).where("ok and u is not null and v is not null").select("u", "v").distinct(), "links")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small, "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    tops = e.select(F.col("v").alias("id")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(tops.select("id", F.col("id").alias("component")))
