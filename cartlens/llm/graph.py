"""Connected components of links between long ids, by alternating large and small stars.

Each round joins links with the smallest neighbour of each node and writes the result to the shared folder, so
neither links nor components pass through the driver, and a lost executor costs its own tasks only. A node
with very many links is a skewed join key, which Spark splits; its neighbours are never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.frames import stored


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` (the smallest id reachable) of every id that has a link to another."""
    links = links.select(
        F.greatest(left, right).cast("long").alias("u"), F.least(left, right).cast("long").alias("v")
    )
    links = stored(links.where("u <> v").distinct(), "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(near, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large-star")
        near = _smallest(large)
        small = large.join(near, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(near.withColumnRenamed("m", "v")).distinct()
        links = stored(small, "small-star")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == state:
            break
        state = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
