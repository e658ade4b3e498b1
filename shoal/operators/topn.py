"""Top-N lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

# Spark trims row_number() <= n per task before the shuffle up to this n
# (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
SALTS = 64


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = "rank",
          salts: int | None = None) -> DataFrame:
    """First ``n`` rows per key in the given total order.

    Every task trims its rows to n per key before they are shuffled, so a key
    holding a third of the rows reaches its reducer as n rows per task. Above
    Spark's own trimming limit (or on request) a salted pass trims first.
    """
    name = rank or "_rank"
    if salts is None:
        salts = 1 if n <= GROUP_LIMIT else SALTS
    if salts > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
        within = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", salt).withColumn("_local", F.row_number().over(within))
              .where(F.col("_local") <= n).drop("_salt", "_local"))
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    ranked = ranked.where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def list_of(df: DataFrame, list_id, item, score, n: int) -> DataFrame:
    """One named list: ``list_id, item, score`` of the n best, ties by item."""
    return (df.select(F.lit(list_id).alias("list_id"), _column(item).cast("string").alias("item"),
                      _column(score).cast("double").alias("score"))
            .orderBy(F.desc("score"), F.asc("item")).limit(n))


def lists_of(df: DataFrame, n: int) -> DataFrame:
    """Cut long rows ``list_id, item, score`` to the n best per list, ties by item."""
    return top_n(df.select("list_id", "item", "score"), ["list_id"], [F.desc("score"), F.asc("item")], n, rank=None)


def rank_any_under(df: DataFrame, scores: list[str], k: int, key: str) -> DataFrame:
    """Rows whose rank is below k for any of the scores, ties sharing a rank.

    A global rank would sort everything in one task. A row ranks below k exactly when its score is among the k-1 best, so
    the scores are stacked as (score, value), cut to the k-1 best of each in every task, and the least of them is the bound:
    one row per score, which the driver gets. Nulls rank last. The rows are written once and read twice.
    """
    rows = stored(df, "ranked")
    stacked = rows.select(F.explode(F.array(*[F.struct(F.lit(s).alias("name"), F.col(s).cast("double").alias("value")) for s in scores])).alias("e"))
    best = top_n(stacked.select("e.name", "e.value").where(F.col("value").isNotNull()), ["name"], [F.desc("value")], max(k - 1, 0))
    bounds = {r["name"]: r for r in best.groupBy("name").agg(F.min("value").alias("lowest"), F.count("*").alias("found")).collect()}
    kept = F.lit(False)
    for score in scores:
        bound = bounds.get(score)
        if bound is None or bound.found < k - 1:
            kept = F.lit(True)  # fewer than k values: every row ranks below k
        else:
            kept = kept | F.coalesce(F.col(score).cast("double") >= bound.lowest, F.lit(False))
    return rows.where(kept)


def mirrored(pairs: DataFrame, score: str = "sim") -> DataFrame:
    """Both directions of undirected pairs in one pass: ``id, item, score``."""
    both = F.array(F.struct(F.col("item_1").alias("id"), F.col("item_2").alias("item")),
                   F.struct(F.col("item_2").alias("id"), F.col("item_1").alias("item")))
    return pairs.select(F.explode(both).alias("p"), F.col(score).alias("score")).select("p.id", "p.item", "score")


def i2i_top_n(pairs: DataFrame, n: int = 100, min_score: float | None = None, allow: DataFrame | None = None,
              deny: DataFrame | None = None, directed: bool = False, ascending: bool = False,
              score: str = "sim") -> DataFrame:
    """``id, item, score, rank``: the n best neighbours of every item, ties by item.

    ``min_score`` bounds similarities from below, or distances from above when
    ``ascending``. ``allow`` and ``deny`` hold recommendable and barred items in
    their first column and act on the neighbour side.
    """
    if min_score is not None:
        pairs = pairs.where(F.col(score) <= min_score if ascending else F.col(score) >= min_score)
    rows = (pairs.select(F.col("item_1").alias("id"), F.col("item_2").alias("item"), F.col(score).alias("score"))
            if directed else mirrored(pairs, score))
    if allow is not None:
        rows = rows.join(allow.select(F.col(allow.columns[0]).cast("string").alias("item")).distinct(), "item", "left_semi")
    if deny is not None:
        rows = rows.join(deny.select(F.col(deny.columns[0]).cast("string").alias("item")).distinct(), "item", "left_anti")
    best = F.asc("score") if ascending else F.desc("score")
    return top_n(rows.select("id", "item", "score"), ["id"], [best, F.asc("item")], n)


def i2i_maps(lists: DataFrame, name: str = "neighbours") -> DataFrame:
    """Map view ``id → {item: score}`` of lists already cut to a top-N."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "item", "score")))
    entries = F.transform(ordered, lambda e: F.struct(e["item"], e["score"]))
    return lists.groupBy("id").agg(F.map_from_entries(entries).alias(name))


def i2i_stats(lists: DataFrame) -> DataFrame:
    """One row about i2i lists: items covered, list lengths, similarity range."""
    per_item = lists.groupBy("id").agg(F.count("*").alias("n"), F.max("score").alias("hi"), F.min("score").alias("lo"))
    return per_item.agg(F.count("*").alias("items"), F.max("n").alias("max_neighbours"),
                        F.min("n").alias("min_neighbours"), F.max("hi").alias("max_score"),
                        F.min("lo").alias("min_score"))


def recall_counts(lists: DataFrame, n: int = 5) -> DataFrame:
    """The n most and the n least recalled neighbour items."""
    counts = stored(lists.groupBy("item").agg(F.count("*").alias("times")), "times")
    most = counts.orderBy(F.desc("times"), "item").limit(n).select(F.lit("most").alias("side"), "item", "times")
    least = counts.orderBy("times", "item").limit(n).select(F.lit("least").alias("side"), "item", "times")
    return most.unionByName(least)
