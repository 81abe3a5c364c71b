"""Connected components by alternating large-star and small-star steps.

Edges are kept as ``u > v``. A large-star step links every neighbour above a node to the
least neighbour of the node, a small-star step every neighbour below it; both keep the
components, and together they end in stars round the least node. Each step is two
aggregations, combined before their shuffle, and joins with a written table, so that a node
with very many neighbours is split as a skewed join. Nothing but two numbers per round, a
count and a checksum, reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from softsearch.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (long) that is not the least of its
    component. Loops, repeated and null edges are ignored; without edges there are no rows."""
    e = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now[0] == 0 or now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        # large star: the least neighbour of v, which lies below v
        least = saved(e.groupBy("u").agg(F.min("v").alias("m")), "least")
        below = least.select(F.col("u").alias("v"), "m")
        large = saved(e.join(below, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct(), "large-star")
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "small-star")
