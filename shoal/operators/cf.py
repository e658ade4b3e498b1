"""Collaborative filtering: itemCF, Swing, ALS."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stored
from .cells import block_count, messages, numbered, pair_sums, shared_pairs
from .pairs import BLOCK_ROWS, group_sizes, large_groups
from .products import top_by_product
from .topn import i2i_top_n


#: Ratings of a block of the factorisation; few ratings are dealt to Spark's ten blocks.
ALS_ROWS = 1 << 22
ALS_BLOCKS = 10


def ratings_of(df: DataFrame, user: str | None = None, item: str | None = None, score: str | None = None) -> DataFrame:
    """``user_id, item_id, score`` as string, string, double.

    Columns of these names are taken, else the first three by position, unless
    named otherwise. One row per user and item is expected.
    """
    standard = ["user_id", "item_id", "score"]
    found = standard if set(standard) <= set(df.columns) else df.columns[:3]
    names = [given or by_place for given, by_place in zip((user, item, score), found)]
    return df.select(F.col(names[0]).cast("string").alias("user_id"), F.col(names[1]).cast("string").alias("item_id"),
                     F.col(names[2]).cast("double").alias("score"))


def _norms(ratings: DataFrame) -> DataFrame:
    return ratings.where(F.col("score") != 0).groupBy("item_id").agg(
        F.sqrt(F.sum(F.col("score") * F.col("score"))).alias("norm"))


def item_cf(df: DataFrame, version: str = "V1", block_rows: int = BLOCK_ROWS, best: int | None = None) -> DataFrame:
    """``item_1, item_2, sim``: cosine of the items' user vectors, each pair once.

    V2 divides every user's term by the square root of the user's item count. Pairs are summed where they are made
    (:mod:`.cells`). With ``best`` the pairs come in both directions, and only those that can be among the ``best`` first
    of ``item_1``, compared to twelve places.
    """
    if version not in ("V1", "V2"):
        raise ValueError(f"unknown itemCF version {version}")
    ratings = stored(ratings_of(df), "ratings")
    items = numbered(ratings, "item_id").join(_norms(ratings), "item_id").withColumn("scale", 1 / F.col("norm"))
    items = stored(items, "items")
    sizes = group_sizes(ratings, ["user_id"])
    rows = ratings.join(items.select("item_id", "place"), "item_id")
    if version == "V2":
        # Either side bears the square root of the term's weight.
        rows = rows.join(sizes, "user_id").withColumn("score", F.col("score") / F.sqrt(F.sqrt("group_rows")))
    blocks = block_count(ratings)
    sent = messages(rows, "user_id", "place", ["score"], blocks, large_groups(sizes, ["user_id"], block_rows))
    sums = pair_sums(sent, items, "item_id", blocks, 1, lambda a, b: a[:, 0] * b[:, 0], "scale", best)
    return sums.toDF("item_1", "item_2", "sim") if best else sums.select("item_1", "item_2", F.col("sum").alias("sim"))


def band_keys(df: DataFrame, key: str, low: float | None = None, high: float | None = None,
              distinct: str | None = None) -> DataFrame:
    """Keys with between ``low`` and ``high`` rows (or distinct values), both included."""
    size = F.count_distinct(distinct) if distinct else F.count("*")
    counts = df.groupBy(key).agg(size.alias("_n"))
    if low is not None:
        counts = counts.where(F.col("_n") >= low)
    if high is not None:
        counts = counts.where(F.col("_n") <= high)
    return counts.select(key)


def within_band(df: DataFrame, key: str, low: float | None = None, high: float | None = None,
                distinct: str | None = None) -> DataFrame:
    """Rows whose key lies in the band of :func:`band_keys`."""
    if low is None and high is None:
        return df
    return df.join(band_keys(df, key, low, high, distinct), key, "left_semi").select(*df.columns)


def swing(df: DataFrame, version: str = "V1", alpha: float = 1.0, user_items: tuple = (None, None),
          item_users: tuple = (None, None), classic: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``item_1, item_2, sim`` by Swing.

    A pair of users who share n item pairs adds 1/(alpha + n) to each of them; a
    user paired with themselves counts too. ``classic`` uses the number of shared
    items instead and different users only.

    * ``V1``: the plain sum
    * ``V1p1``: times (s_ui·s_vi + s_uj·s_vj) / sqrt(‖i‖·‖j‖)
    * ``V2``: times 1/sqrt(|I_u|) · 1/sqrt(|I_v|)
    * ``V3``: the V2 weight times (s_ui·s_uj + s_vi·s_vj) / sqrt(‖i‖·‖j‖)

    ``user_items`` and ``item_users`` bound the activity of users and items; both
    bounds are judged on the unfiltered input.
    """
    if version not in ("V1", "V1p1", "V2", "V3"):
        raise ValueError(f"unknown Swing version {version}")
    everything = ratings_of(df)
    ratings = everything
    for key, (low, high) in (("item_id", item_users), ("user_id", user_items)):
        if low is not None or high is not None:
            ratings = ratings.join(band_keys(everything, key, low, high), key, "left_semi")

    # Users with one item form no item pair.
    ratings = stored(ratings, "ratings")
    sizes = group_sizes(ratings, ["user_id"]).where(F.col("group_rows") >= 2)
    items, users = numbered(ratings, "item_id"), numbered(ratings, "user_id")
    rows = stored(ratings.join(sizes, "user_id").join(items, "item_id").join(users.withColumnRenamed("place", "user_place"), "user_id").select(
        "user_id", "item_id", "place", "user_place", "score", F.col("group_rows").cast("double").alias("k")), "rows")
    blocks = block_count(rows)

    # Users who share m items share m(m-1)/2 item pairs.
    def weight(shared, u, v):
        w = 1 / (alpha + (shared if classic else shared * (shared - 1) / 2))
        return w / np.sqrt(u[:, 1] * v[:, 1]) if version in ("V2", "V3") else w

    def term(shared, ui, vi, uj, vj):
        w = weight(shared, ui, vi)
        if version == "V1p1":
            return w * (ui[:, 2] * vi[:, 2] + uj[:, 2] * vj[:, 2])
        if version == "V3":
            return w * (ui[:, 2] * uj[:, 2] + vi[:, 2] * vj[:, 2])
        return w

    scored = version in ("V1p1", "V3")
    columns = ["place", "k"] + ["score"] * scored
    held = messages(rows, "item_id", "user_place", columns, blocks, large_groups(group_sizes(rows, ["item_id"]), ["item_id"], block_rows))
    sent = shared_pairs(held, blocks, len(columns), blocks, term)
    if not classic:
        # A user with themselves shares all k(k-1)/2 pairs.
        own = 1 / (F.lit(alpha) + F.col("k") * (F.col("k") - 1) / 2)
        if version in ("V2", "V3"):
            own = own / F.col("k")
        mine = rows.withColumn("own", own)
        large = large_groups(sizes, ["user_id"], block_rows)
        sent = sent.unionByName(messages(mine, "user_id", "place", ["own"] + ["score"] * scored, blocks, large))

    def own_term(a, b):
        if version == "V1p1":
            return a[:, 0] * (a[:, 1] * a[:, 1] + b[:, 1] * b[:, 1])
        return a[:, 0] * 2 * a[:, 1] * b[:, 1] if version == "V3" else a[:, 0]

    scale = None
    if scored:
        items, scale = items.join(_norms(ratings), "item_id").withColumn("scale", 1 / F.sqrt("norm")), "scale"
    return pair_sums(sent, items, "item_id", blocks, 1 + scored, own_term, scale).select("item_1", "item_2", F.col("sum").alias("sim"))


def item_lists(pairs: DataFrame, n: int = 100, min_score: float | None = None) -> DataFrame:
    """``id, item, score, rank``: the n most similar items of every item, from pairs that each stand once.

    Similarities are compared to twelve places; below that ties go by item.
    """
    return i2i_top_n(pairs.withColumn("sim", F.round("sim", 12)), n, min_score)


def merge_similarities(*sources: DataFrame) -> DataFrame:
    """Sum of several undirected similarity lists, each pair once and ordered."""
    stacked = None
    for source in sources:
        part = source.select(F.least("item_1", "item_2").alias("item_1"), F.greatest("item_1", "item_2").alias("item_2"), "sim")
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy("item_1", "item_2").agg(F.sum("sim").alias("sim"))


def dense_ids(df: DataFrame, column: str, name: str = "idx", buckets: int = 4096) -> DataFrame:
    """Distinct values with consecutive integers from 0.

    Values are numbered inside hash buckets in parallel and shifted by the
    buckets' running sizes, a table of at most ``buckets`` rows.
    """
    values = df.select(column).distinct().withColumn("_b", F.pmod(F.xxhash64(column), F.lit(buckets)))
    sizes = values.groupBy("_b").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy(column))
    return (values.withColumn("_r", rank).join(offsets, "_b")
            .select(column, (F.col("_offset") + F.col("_r") - 1).cast("int").alias(name)))


def als_factors(df: DataFrame, rank: int = 100, max_iter: int = 10, reg: float = 0.1, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``id, vector`` of users and of items by matrix factorisation.

    A task sorts a block's ratings in memory, so blocks are as many as keep them below ALS_ROWS.
    """
    from pyspark.ml.recommendation import ALS

    ratings = stored(ratings_of(df), "ratings")
    users, items = stored(dense_ids(ratings, "user_id", "user_idx"), "users"), stored(dense_ids(ratings, "item_id", "item_idx"), "items")
    indexed = ratings.join(users, "user_id").join(items, "item_id").select("user_idx", "item_idx", F.col("score").cast("float"))
    blocks = max(ALS_BLOCKS, -(-ratings.count() // ALS_ROWS))
    model = ALS(userCol="user_idx", itemCol="item_idx", ratingCol="score", rank=rank, maxIter=max_iter,
                regParam=reg, seed=seed, numUserBlocks=blocks, numItemBlocks=blocks).fit(indexed)
    named = [(users, "user", model.userFactors), (items, "item", model.itemFactors)]
    return tuple(stored(factors.join(names.select(F.col(f"{who}_idx").alias("id"), F.col(f"{who}_id").alias("name")), "id")
                        .select(F.col("name").alias("id"), F.col("features").cast("array<double>").alias("vector")), f"{who}-factors")
                 for names, who, factors in named)


def als_residuals(df: DataFrame, users: DataFrame, items: DataFrame, rank: int, reg: float) -> DataFrame:
    """``user_id, ratings, residual``: how far each user's factor is from solving its regularised normal equations.

    The largest entry of ``sum(v (v·u - score)) + reg * ratings * u`` over the largest of ``sum(v * score)``, v the rated
    items' factors. Users are fitted last, so their residuals are rounding only.
    """
    rows = (ratings_of(df).join(users.select(F.col("id").alias("user_id"), F.col("vector").alias("u")), "user_id")
            .join(items.select(F.col("id").alias("item_id"), F.col("vector").alias("v")), "item_id"))
    off = F.aggregate(F.zip_with("u", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x) - F.col("score")
    v = [F.col("v")[i] for i in range(rank)]
    summed = rows.withColumn("off", off).groupBy("user_id").agg(
        F.count("*").alias("ratings"), F.first("u").alias("u"), F.array(*[F.sum(x * F.col("off")) for x in v]).alias("left"),
        F.array(*[F.sum(x * F.col("score")) for x in v]).alias("right"))
    gap = F.array_max(F.zip_with("left", "u", lambda a, x: F.abs(a + F.lit(reg) * F.col("ratings") * x)))
    return summed.select("user_id", "ratings", (gap / F.greatest(F.array_max(F.transform("right", F.abs)), F.lit(1e-300))).alias("residual"))


def als_top_k(df: DataFrame, k: int = 100, rank: int = 100, max_iter: int = 10, reg: float = 0.1, seed: int = 42) -> DataFrame:
    """``user_id, item_id, rating, rank``: the k best items per user by matrix factorisation, ties by item.

    Items are looked through in order of their factors' length (:mod:`.products`), not all users times all items.
    """
    users, items = als_factors(df, rank, max_iter, reg, seed)
    return top_by_product(users, items, k).select(F.col("id").alias("user_id"), F.col("item").alias("item_id"), F.col("score").alias("rating"), "rank")
