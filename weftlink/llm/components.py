"""Connected components of a graph held in a table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _lowest(pairs: DataFrame) -> DataFrame:
    """v, u and m, the least of v and all its u; minima are aggregated before any shuffle, so a hub is no burden."""
    least = pairs.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("m", "v"))
    return pairs.join(least, "v")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """From links (a, b) of long ids: a row (v, low) for each linked id, low being the least id it reaches.

    Alternates the large-star and small-star steps, which keep the components and end with every id
    linked to its component's least.  Each round is written to the shared folder.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    links = stored(links, "links")
    before = None
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        large = _lowest(both).where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        low = _lowest(large)
        small = low.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(low.select("v", F.col("m").alias("u"))).where("v <> u").distinct()
        old, links = links, stored(small, "links")
        discard(old)
        state = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return links.select("v", F.col("u").alias("low"))
