"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for every node of ``edges`` (``a``, ``b``, longs).

    Large-star and small-star steps: each node's neighbours are tied to its least neighbour until every component is
    a star. The rounds grow with the logarithm of the longest path; each is written to the shared folder. Nothing is
    collected but a count and a sum. Loops and nulls are left out; an empty table gives no rows.
    """
    pairs = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("x"), "m")
                 .unionByName(down.select(F.col("a").alias("x"), "m")).filter("x <> m")
                 .select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct())
        pairs = stored(small, "edges")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    stars = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
