"""Per-user profiles, tiers and flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.nested import union_of
from .filters import FIRST_GAME, valid_id
from .sets import dedup

# Tier limits in seconds, card position of a glide user, vector length.
LIGHT_BELOW, HEAVY_ABOVE = 6, 20
GLIDE_FROM = 3
EMBEDDING_SIZE = 256


def _items(condition: Column) -> Column:
    return F.collect_set(F.when(condition, F.col("item_id").cast("string")))


def _filled(array: Column) -> Column:
    """Empty sets as null, as a missing row in an outer join would be."""
    return F.when(F.size(array) > 0, array)


def behaviour_profile(log: DataFrame, catalog: DataFrame, starts: dict[str, str], end: str, actions: dict[str, list[str]]) -> DataFrame:
    """Item sets per user: clicked, downloaded (all, app, game), installed, activated, and clicked ∪ downloaded.

    ``starts`` and ``actions`` are keyed by ``click, download, install, activate``.
    All sets come from one aggregate over one scan.
    """
    rows = log.join(catalog.select("item_id", "category_id"), "item_id", "left")
    game, app = F.col("category_id") >= FIRST_GAME, F.col("category_id").between(0, FIRST_GAME - 1)
    when = {k: F.col("date").between(starts[k], end) & F.col("action").isin(actions[k]) for k in starts}
    sets = {"click": when["click"], "click_app": when["click"] & app, "click_game": when["click"] & game,
            "download": when["download"], "download_app": when["download"] & app, "download_game": when["download"] & game,
            "install": when["install"], "activate": when["activate"]}
    wanted = reduce(lambda a, b: a | b, when.values())
    grouped = rows.where(wanted & F.col("user_id").isNotNull() & F.col("item_id").isNotNull()).groupBy("user_id").agg(
        *[_items(c).alias(k) for k, c in sets.items()])
    return grouped.select(
        "user_id", *[_filled(F.col(k)).alias(k) for k in sets],
        _filled(union_of("click_app", "download_app")).alias("click_download_app"),
        _filled(union_of("click_game", "download_game")).alias("click_download_game"))


def action_sequences(log: DataFrame, catalog: DataFrame, downloads: list[str], plays: list[str]) -> DataFrame:
    """``user_id, download_seq, play_seq, kind`` of ``item&time`` parts, oldest first, for games and apps.

    An item counts once per user and action, at its first time, so a sequence is
    at most as long as the catalog.
    """
    rows = log.where(F.col("action").isin(downloads + plays)).join(catalog.select("item_id", "category_id"), "item_id")
    first = rows.groupBy("user_id", "item_id", "category_id", "action").agg(F.min("time_ms").alias("time_ms"))
    kind = F.when(F.col("category_id") >= FIRST_GAME, "game").when(F.col("category_id") > 0, "app")

    def sequence(names: list[str]) -> Column:
        part = F.struct("time_ms", "item_id")
        ordered = F.array_sort(F.collect_list(F.when(F.col("action").isin(names), part)))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws("&", s["item_id"].cast("string"), s["time_ms"].cast("string"))), ",")

    return (first.withColumn("kind", kind).where(F.col("kind").isNotNull()).groupBy("user_id", "kind")
            .agg(sequence(downloads).alias("download_seq"), sequence(plays).alias("play_seq")))


def platform_profile(log: DataFrame, month: tuple[str, str], week: tuple[str, str], usage_lists: DataFrame | None = None,
                     names: tuple[str, str, str] = ("download_install", "install", "activate")) -> DataFrame:
    """Downloads of a month, installs and activations of a week, joined with the most used items."""
    down, inst, act = names
    sets = {"download": (F.col("action") == down) & F.col("date").between(*month),
            "install": (F.col("action") == inst) & F.col("date").between(*week),
            "activate": (F.col("action") == act) & F.col("date").between(*week)}
    wanted = reduce(lambda a, b: a | b, sets.values())
    grouped = log.where(wanted).groupBy("user_id").agg(*[_items(c).alias(k) for k, c in sets.items()])
    profile = grouped.select("user_id", *[_filled(F.col(k)).alias(k) for k in sets])
    if usage_lists is None:
        return profile
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col("item_id").cast("string").alias("item"))))
    used = usage_lists.groupBy("user_id").agg(F.transform(ordered, lambda s: s["item"]).alias("used"))
    return profile.join(used, "user_id", "full")


def launched(ignored: list[str], page_refs: list[str]) -> Column:
    """A real launch: a known, not ignored launch source, or one of the page references."""
    known = F.col("launch_ref").isNotNull() & (F.col("launch_ref") != "") & ~F.col("launch_ref").isin(ignored)
    return known | F.col("page_ref").isin(page_refs)


def _flag(condition: Column, name: str) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int").alias(name)


def glide_flags(log: DataFrame, ignored: list[str], page_refs: list[str], card: str = "recApps") -> DataFrame:
    """Did the user scroll to card position 3 or beyond."""
    rows = log.where(valid_id("user_id") & launched(ignored, page_refs))
    deepest = rows.groupBy("user_id").agg(F.max(F.when(F.col("card_type") == card, F.col("card_pos")).otherwise(0)).alias("p"))
    return deepest.select("user_id", _flag(F.col("p") >= GLIDE_FROM, "is_glide"), _flag(F.col("p") < GLIDE_FROM, "is_not_glide"))


def duration_tiers(log: DataFrame, ignored: list[str], page_refs: list[str], action: str, duration_ms: Column) -> DataFrame:
    """Light, middle and heavy users by seconds spent."""
    rows = log.where(valid_id("user_id") & launched(ignored, page_refs))
    spent = rows.groupBy("user_id").agg((F.sum(F.when(F.col("action") == action, duration_ms).otherwise(0.0)) / 1000).alias("s"))
    s = F.col("s")
    return spent.select("user_id", _flag(s < LIGHT_BELOW, "is_light"), _flag(s.between(LIGHT_BELOW, HEAVY_ABOVE), "is_middle"),
                        _flag(s > HEAVY_ABOVE, "is_heavy"))


def active_flags(log: DataFrame, home: str, ignored: list[str], page_refs: list[str]) -> DataFrame:
    """``is_active`` 1 for users who ever opened from home, else ``is_passive`` 1; the other one is null."""
    opened = log.where(launched(ignored, page_refs)).groupBy("user_id").agg(
        F.max(F.coalesce(F.col("launch_ref") == home, F.lit(False)).cast("int")).alias("o"))
    return opened.select("user_id", F.when(F.col("o") == 1, 1).alias("is_active"), F.when(F.col("o") != 1, 1).alias("is_passive"))


def level_flags(levels: DataFrame, prefix: str, names: tuple[str, ...] = ("high", "mid", "low")) -> DataFrame:
    """``user_id, level`` rows pivoted to one flag per level (1 or null), one row per user."""
    return levels.where(F.col("level").isin(*names)).groupBy("user_id").agg(
        *[F.max(F.when(F.col("level") == n, 1)).alias(f"{prefix}_{n}") for n in names])


def game_flags(usage: DataFrame, catalog: DataFrame, min_frequency: float, min_duration: float) -> DataFrame:
    """Users whose mean game usage reaches either limit."""
    games = catalog.where(F.col("category_id") >= FIRST_GAME).select("item_id")
    means = (usage.where(valid_id("user_id")).join(games, "item_id", "left_semi").groupBy("user_id")
             .agg(F.avg("frequency").alias("f"), F.avg("duration").alias("d")))
    return means.where((F.col("f") >= min_frequency) | (F.col("d") >= min_duration)).select("user_id", F.lit(1).alias("is_game_user"))


def hierarchy(log: DataFrame, day: str, week: tuple[str, str], home: str, action: str, duration_ms: Column, ignored: list[str],
              page_refs: list[str], levels: dict[str, Column], prefix: str, card: str = "recApps") -> DataFrame:
    """All flags of :func:`glide_flags`, :func:`duration_tiers`, :func:`active_flags` and :func:`level_flags` in one aggregate.

    Glide and launch flags look at ``day``, seconds at ``week``, ``levels`` (name: condition on ``n``, the first that
    holds) at all rows of the user. A flag is null where its own rows are missing, as after a full join. Invalid ids go.
    """
    real = launched(ignored, page_refs)
    today, weekly = (F.col("date") == day) & real, F.col("date").between(*week) & real
    per_user = log.where(valid_id("user_id")).groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_if(today).alias("_t"), F.count_if(weekly).alias("_w"),
        F.max(F.when(today, F.when(F.col("card_type") == card, F.col("card_pos")).otherwise(0))).alias("_p"),
        (F.sum(F.when(weekly, F.when(F.col("action") == action, duration_ms).otherwise(0.0))) / 1000).alias("_s"),
        F.max(F.when(today, F.coalesce(F.col("launch_ref") == home, F.lit(False)).cast("int"))).alias("_o"))
    level = F.lit(None).cast("string")
    for name, condition in reversed(levels.items()):
        level = F.when(condition, F.lit(name)).otherwise(level)
    there = lambda count, flag: F.when(F.col(count) > 0, flag)
    p, s = F.col("_p"), F.col("_s")
    return per_user.withColumn("_level", level).select(
        "user_id", there("_t", _flag(p >= GLIDE_FROM, "x")).alias("is_glide"), there("_t", _flag(p < GLIDE_FROM, "x")).alias("is_not_glide"),
        there("_w", _flag(s < LIGHT_BELOW, "x")).alias("is_light"), there("_w", _flag(s.between(LIGHT_BELOW, HEAVY_ABOVE), "x")).alias("is_middle"),
        there("_w", _flag(s > HEAVY_ABOVE, "x")).alias("is_heavy"), F.when(F.col("_o") == 1, 1).alias("is_active"),
        F.when(F.col("_o") != 1, 1).alias("is_passive"), *[F.when(F.col("_level") == name, 1).alias(f"{prefix}_{name}") for name in levels])


def sensitive_users(profiles: DataFrame, columns: list[str], barred: DataFrame) -> DataFrame:
    """``user_id, items, is_sensitive``: users with a barred item in any of the profile arrays."""
    arrays = [F.coalesce(F.col(c), F.array().cast("array<string>")) for c in columns]
    held = profiles.select("user_id", F.explode(F.array_distinct(F.concat(*arrays))).alias("item"))
    hits = held.join(barred.select(F.col(barred.columns[0]).cast("string").alias("item")), "item", "left_semi")
    return hits.groupBy("user_id").agg(F.collect_set("item").alias("items")).withColumn("is_sensitive", F.lit(1))


def _one_per(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the least by its other columns."""
    return df.select(key).distinct() if df.columns == [key] else dedup(df, [key], [])


def merged(sources: list[DataFrame], key: str = "user_id", only_valid: bool = False) -> DataFrame:
    """Full outer join of any number of frames on one key, one row per key from each.

    All sides are hashed by the same key, so each is shuffled once.
    """
    sides = [s.where(valid_id(key)) if only_valid else s for s in sources]
    return reduce(lambda a, b: a.join(b, key, "full"), [_one_per(s, key) for s in sides])


def user_features(audiences: DataFrame, features: DataFrame, vectors: list[str], size: int = EMBEDDING_SIZE) -> DataFrame:
    """One row per user: audience label and features, absent vectors as zeros.

    A user in several audiences takes the first label in order.
    """
    first = audiences.groupBy("user_id").agg(F.min("audience").alias("audience"))
    zeros = F.array_repeat(F.lit(0.0), size)
    joined = first.join(_one_per(features, "user_id"), "user_id", "full")
    return joined.withColumns({v: F.coalesce(F.col(v), zeros) for v in vectors})
