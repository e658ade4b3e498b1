"""Seeded samples: rows, k per key, weighted draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.draws import draw_int, uniform
from ..session import stored, wide_partitions
from .topn import top_n

# Slices of one node's edges whose weights are summed in parallel.
_SLICE_HEX = 2
# Rows of a node above which one task no longer takes them all, and counters that a first check for such nodes needs.
CROWDED = 1 << 20
SLOTS = 1 << 14


def hash_sample(df: DataFrame, fraction: float, seed, *keys) -> DataFrame:
    """Bernoulli sample of rows by a seeded draw on the key columns."""
    return df.where(uniform(seed, *keys) < fraction)


def sample_k_per_key(df: DataFrame, keys: list[str], member: str, k: int, seed) -> DataFrame:
    """k members per key, uniformly and without replacement."""
    drawn = df.withColumn("_draw", draw_int(seed, *keys, member))
    return top_n(drawn, keys, [F.asc("_draw"), F.asc(member)], k, rank=None).drop("_draw")


def unit_intervals(edges: DataFrame) -> DataFrame:
    """``src, dst, weight, low, high``: the node's edges as intervals that cover [0, 1) once.

    Edges are ordered by the first hex digits of the target's MD5 and by target.
    Sums run inside each of the 256 slices of a node and are shifted by the slices
    before, so a hub's edges are not ordered in one task. An edge begins at the
    very double at which the one before it ends, also across slices, and the last
    ends at 1: the sums of the slices are their last running sums.
    """
    sliced = edges.withColumn("_slice", F.substring(F.md5("dst"), 1, _SLICE_HEX))
    within = Window.partitionBy("src", "_slice").orderBy("dst")
    local = (sliced.withColumn("_upto", F.sum("weight").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .withColumn("_from", F.lag("_upto", 1, 0.0).over(within)))
    sums = local.groupBy("src", "_slice").agg(F.max("_upto").alias("_sum"))
    earlier = Window.partitionBy("src").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (sums.withColumn("_shift", F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0)))
              .withColumn("_total", F.max(F.col("_shift") + F.col("_sum")).over(Window.partitionBy("src"))).drop("_sum"))
    return local.join(shifts, ["src", "_slice"]).select(
        "src", "dst", "weight", ((F.col("_shift") + F.col("_from")) / F.col("_total")).alias("low"),
        ((F.col("_shift") + F.col("_upto")) / F.col("_total")).alias("high"))


def crowded(rows: DataFrame, key: str, most: int | None = None) -> DataFrame | None:
    """``key``: values with more than ``most`` rows (by default CROWDED), or None where there are none.

    Rows are counted by a hash of bounded range first; only values that share a full counter are counted one by one.
    """
    most = CROWDED if most is None else most
    slotted = rows.where(F.col(key).isNotNull()).select(key, F.pmod(F.xxhash64(key), F.lit(SLOTS)).alias("_slot"))
    full = stored(slotted.groupBy("_slot").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("_slot"), "full")
    if full.isEmpty():
        return None
    found = stored(slotted.join(full, "_slot", "left_semi").groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(key), "crowded")
    return None if found.isEmpty() else found


def in_line(edges: DataFrame) -> DataFrame:
    """``src, dst, begin, upto, total, edges``: the order of :func:`unit_intervals` with a node's edges in one task.

    For nodes that are not :func:`crowded`. An edge's interval is begin / total to upto / total. Rows that lie by ``src``
    already are not shuffled.
    """
    node = Window.partitionBy("src")
    line = node.orderBy("_slice", "dst")
    sliced = edges.select("src", "dst", F.col("weight").cast("double").alias("weight"), F.substring(F.md5("dst"), 1, _SLICE_HEX).alias("_slice"))
    return (sliced.withColumn("upto", F.sum("weight").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("begin", F.lag("upto", 1, 0.0).over(line))
            .withColumn("total", F.max("upto").over(node)).withColumn("edges", F.count("*").over(node))
            .select("src", "dst", "begin", "upto", "total", "edges"))


def bounds(begin: str = "begin", upto: str = "upto", total: str = "total") -> list[Column]:
    return [(F.col(begin) / F.col(total)).alias("low"), (F.col(upto) / F.col(total)).alias("high")]


def bucket_counts(edges: DataFrame) -> DataFrame:
    """``src, buckets``: the larger of a node's edges out and in.

    Walks arrive over the edges in, so a crowded node has as many buckets to
    spread its arrivals over.
    """
    live = edges.where(F.col("weight") > 0)
    out = live.groupBy("src").agg(F.count("*").alias("_out"))
    into = live.groupBy(F.col("dst").alias("src")).agg(F.count("*").alias("_in"))
    return out.join(into, "src", "left").select("src", F.greatest("_out", F.coalesce("_in", F.lit(0))).alias("buckets"))


def draw_table(edges: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Guide table for weighted draws: ``src, bucket, low, high, dst, buckets``.

    A node has buckets of equal probability (:func:`bucket_counts`); an edge is
    listed in every bucket its interval [low, high) of the unit range touches, so
    the table has at most as many rows as edges and buckets together. A draw
    looks up one bucket and not all edges of a hub.
    """
    live = unit_intervals(edges.where(F.col("weight") > 0).withColumn("weight", F.col("weight").cast("double")))
    ranged = live.join(bucket_counts(edges) if counts is None else counts, "src")
    last = F.col("buckets") - 1
    first_bucket = F.least(last, F.floor(F.col("low") * F.col("buckets")))
    last_bucket = F.least(last, F.floor(F.col("high") * F.col("buckets")))
    return ranged.select("src", F.explode(F.sequence(first_bucket, last_bucket)).alias("bucket"), "low", "high", "dst", "buckets")


def bucket_of(u: Column, buckets: Column) -> Column:
    return F.least(buckets - 1, F.floor(u * buckets))


def weighted_draws(edges: DataFrame, draws: int, seed) -> DataFrame:
    """``src, draw, dst``: targets drawn with replacement in proportion to their weight.

    A node's edges and draws meet in one task; only crowded nodes use the guide table.
    """
    edges = stored(edges, "edges")
    big = crowded(edges, "src")

    inside = lambda u: (u >= F.col("low")) & (u < F.col("high"))
    usual = edges if big is None else edges.join(big, "src", "left_anti")
    live = usual.where((F.col("weight") > 0) & F.col("src").isNotNull()).repartition(wide_partitions(edges.sparkSession), "src")
    # The node's first edge makes the draws, and all its edges see them.
    made = F.transform(F.sequence(F.lit(1), F.lit(draws)), lambda d: F.struct(d.alias("draw"), uniform(seed, "src", d).alias("u")))
    seen = F.first(F.when(F.col("begin") == 0, made), ignorenulls=True).over(Window.partitionBy("src"))
    lined = in_line(live).withColumn("_draws", seen).where(F.col("dst").isNotNull()).select("src", "dst", *bounds(), "_draws")
    hits = F.explode(F.filter("_draws", lambda e: inside(e["u"])))
    lined = lined.select("src", "dst", hits.alias("e")).select("src", "e.draw", "dst")
    if big is None:
        return lined
    hubs = edges.join(big, "src", "left_semi")
    counts = bucket_counts(hubs)
    wanted = (counts.select("src", F.col("buckets").alias("_n"), F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw"))
              .withColumn("u", uniform(seed, "src", "draw"))
              .withColumn("bucket", bucket_of(F.col("u"), F.col("_n"))))
    far = wanted.join(draw_table(hubs, counts).drop("buckets"), ["src", "bucket"]).where(inside(F.col("u")))
    return lined.unionByName(far.select("src", "draw", "dst"))
