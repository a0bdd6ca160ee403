"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txpulse.llm.common import kept, scope, written


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every node u of ``links`` (u, v) but the roots, root the least node of its component.

    Large-star and small-star steps in turn until nothing changes, each a
    map-side combined minimum and a join on the node; every round is written
    to the shared folder. Loops, repeated links and nulls are ignored.
    """
    spark = links.sparkSession
    with scope(spark):
        edges = kept(links.where("u < v").select(F.col("v").alias("u"), F.col("u").alias("v"))
                     .union(links.where("v < u").select("u", "v")).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or (state["n"], state["h"]) == seen:
            return edges.select("u", F.col("v").alias("root"))
        seen = (state["n"], state["h"])
        with scope(spark):  # a round's tables go with it, but for its last one
            both = edges.union(edges.select("v", "u"))
            least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
            large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            large = written(large, "large-star")
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            edges = kept(small.union(least.select("u", "m")).distinct(), "small-star")
