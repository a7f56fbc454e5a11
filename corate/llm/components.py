"""Connected components of an edge table by alternating stars.

Large-star and small-star steps rewire edges to the smallest neighbour until
nothing changes (a logarithmic number of rounds). Each step is an
aggregation and a join; a node with very many neighbours is pre-aggregated
and its join partition can be split by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns a, b), ``root``
    being the smallest node of its component."""
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = materialize(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small, "small-star")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    low = e.groupBy("u").agg(F.min("v").alias("root"))
    return (low.select(F.col("u").alias("node"), "root")
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
