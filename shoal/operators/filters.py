"""Locale, id and item filters; the eligible item pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import day_shift
from ..functions.nested import json_list
from .cf import within_band

# The all-zero device id, and the first category number of games.
ZERO_ID = "00000000-0000-0000-0000-000000000000"
FIRST_GAME = 100

# Reference spelling of "all of one cluster" and the joint name of lists.
JOINT_NAME = "OTHER"


def locales_of(regions: DataFrame, wanted: str, widening: tuple[str, ...] = ()) -> DataFrame:
    """One column ``locale``: the locales a predicate stands for.

    ``wanted`` is one locale, a comma list or a cluster name. If it names a
    widening cluster or any member of one, it stands for that whole cluster.
    """
    names = [w.strip() for w in wanted.split(",")]
    hit = F.col("locale").isin(names) | F.col("cluster").isin(names)
    named = regions.where(hit)
    if widening:
        clusters = named.where(F.col("cluster").isin(list(widening))).select("cluster").distinct()
        whole = regions.join(clusters, "cluster", "left_semi").select("locale")
        named = named.select("locale").unionByName(whole)
    return named.select("locale").distinct()


def in_locale(df: DataFrame, regions: DataFrame, wanted: str, column: str = "locale", widening: tuple[str, ...] = ()) -> DataFrame:
    allowed = locales_of(regions, wanted, widening).withColumnRenamed("locale", column)
    return df.join(allowed, column, "left_semi")


def locale_flags(regions: DataFrame, predicates: dict[str, tuple[str, tuple[str, ...] | bool]]) -> DataFrame:
    """``locale`` and one flag per predicate ``name: (wanted, widening)``, so that one join serves many predicates.

    As :func:`locales_of`; ``widening`` True widens to the cluster of any locale named, whatever it is.
    """
    flagged = regions.select("locale", "cluster").distinct()
    for at, (wanted, widening) in enumerate(predicates.values()):
        names = [w.strip() for w in wanted.split(",")]
        hit = F.col("locale").isin(names) | F.col("cluster").isin(names)
        if widening:
            wide = F.lit(True) if widening is True else F.col("cluster").isin(list(widening))
            hit = hit | F.coalesce(F.max(hit & wide).over(Window.partitionBy("cluster")), F.lit(False))
        flagged = flagged.withColumn(f"_flag_{at}", hit)
    return flagged.groupBy("locale").agg(*[F.max(f"_flag_{at}").alias(name) for at, name in enumerate(predicates)])


def locale_name(c, joint: tuple[str, ...] | Column = ()) -> Column:
    """Storage name of a locale argument: lists and joint clusters (by name or by a condition) become ``OTHER``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.contains(",") | (joint if isinstance(joint, Column) else c.isin(list(joint))), JOINT_NAME).otherwise(c)


def valid_id(c) -> Column:
    """Neither null, empty nor the all-zero id."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & ~c.isin("", ZERO_ID)


def allow_deny(df: DataFrame, column: str, allow: DataFrame | None = None, deny: DataFrame | None = None) -> DataFrame:
    """Keep allowed and drop denied values; the lists hold them in their first column."""
    for frame, how in ((allow, "left_semi"), (deny, "left_anti")):
        if frame is not None:
            df = df.join(frame.select(F.col(frame.columns[0]).alias(column)), column, how)
    return df


def by_class(df: DataFrame, kind: str, column: str = "category_id") -> DataFrame:
    """``game`` from the first game category on, ``app`` below, ``all`` everything."""
    if kind == "game":
        return df.where(F.col(column) >= FIRST_GAME)
    return df.where(F.col(column) < FIRST_GAME) if kind == "app" else df


def audit_deny_list(tags: DataFrame, barred: list, end: str, days: int = 7) -> DataFrame:
    """``item_id`` with a barred tag in the trailing days; an empty list is an error.

    ``tags`` holds ``item_id, audit_tag, date``.
    """
    found = (tags.where(F.col("date").between(day_shift(end, -days), end) & F.col("audit_tag").isin(barred))
             .select("item_id").distinct())
    if found.isEmpty():
        raise ValueError("the deny list is empty")
    return found


def hot_deny_list(lists: DataFrame, names: list[str], n: int = 200) -> DataFrame:
    """``item``: union of the n best of the named hot lists (``list_id, item, score``)."""
    from .topn import lists_of

    return lists_of(lists.where(F.col("list_id").isin(names)), n).select("item").distinct()


def eligible_items(catalog: DataFrame, end: str, trailing_levels: list[str], last_levels: list[str], kind: str = "all",
                   deny: list[DataFrame] = (), quality: DataFrame | None = None, uninstalls: DataFrame | None = None,
                   min_score: float = 2.0, min_retention: float = 0.05, min_usage: float = 1.0, max_uninstall: float = 0.7,
                   trailing_days: int = 8) -> DataFrame:
    """``item_id`` of the recommendable items.

    Levels count if seen on the last day (``last_levels``) or on an earlier day
    of the trailing window (``trailing_levels``). Kept are items that ever reach
    both scores in the window, with enough retention or usage (``quality``:
    ``item_id, retention, usage``), outside the deny lists, and not low-level
    items uninstalled within the hour too often (``uninstalls``: ``item_id,
    level, hour_rate``).
    """
    last = catalog.where(F.col("date") <= end).agg(F.max("date").alias("d")).scalar()
    day = F.to_date("date", "yyyyMMdd")
    window = by_class(catalog.where((F.col("date") <= last) & (F.date_diff(F.to_date(last, "yyyyMMdd"), day) <= trailing_days)), kind)
    # One pass over the window: did the item ever qualify by level, and by either score.
    level_hit = (((F.col("date") == last) & F.col("level").isin(last_levels))
                 | ((F.col("date") < last) & F.col("level").isin(trailing_levels)))
    pool = (window.groupBy("item_id").agg(
        F.bool_or(level_hit).alias("a"), F.bool_or(F.col("gp_score") >= min_score).alias("b"),
        F.bool_or(F.col("display_score") >= min_score).alias("c")).where("a and b and c").select("item_id"))
    if quality is not None:
        fit = quality.where((F.col("retention") >= min_retention) | (F.col("usage") >= min_usage))
        pool = pool.join(fit.select("item_id"), "item_id", "left_semi")
    if uninstalls is not None:
        dropped = uninstalls.where(F.col("level").isin("C", "D") & (F.col("hour_rate") > max_uninstall))
        pool = pool.join(dropped.select("item_id"), "item_id", "left_anti")
    for barred in deny:
        pool = pool.join(barred.select(F.col(barred.columns[0]).alias("item_id")), "item_id", "left_anti")
    return pool


def catalog_by_level(latest: DataFrame, levels: list[str]) -> DataFrame:
    return latest.where(F.col("level").isin(levels)).select("item_id", "level", "category_id", "tagids")


def item_tags(latest: DataFrame) -> DataFrame:
    """``item_id, tag``: one row per item and tag of the JSON list."""
    return (latest.select("item_id", F.explode(json_list("tagids")).alias("tag")).where(F.col("tag").isNotNull())
            .select("item_id", F.col("tag").cast("int").alias("tag")).distinct())


def item_tags_filtered(latest: DataFrame, exposures: DataFrame, downloads: DataFrame, min_items: int = 100,
                       min_rate: float = 0.005) -> DataFrame:
    """Item tags whose tag has enough items and enough downloads per exposed user.

    ``exposures`` and ``downloads`` hold ``item_id, date`` with ``exposure_uv`` and ``download_puv``.
    """
    tags = item_tags(latest)
    common = tags.groupBy("tag").agg(F.count("*").alias("n")).where(F.col("n") >= min_items).select("tag")
    per_item = (exposures.join(downloads, ["item_id", "date"]).groupBy("item_id")
                .agg(F.sum("exposure_uv").alias("e"), F.sum("download_puv").alias("d")))
    good = (per_item.join(tags, "item_id").groupBy("tag").agg(F.sum("e").alias("e"), F.sum("d").alias("d"))
            .where(F.try_divide("d", "e") >= min_rate).select("tag"))
    return tags.join(common, "tag", "left_semi").join(good, "tag", "left_semi")


def activity_band(df: DataFrame, user: str, item: str, user_items: tuple | None = None, item_users: tuple | None = None) -> DataFrame:
    """Open ranges, off by default: users with a < items < b, then items with a < users < b among their rows."""
    kept = df if user_items is None else within_band(df, user, user_items[0] + 1, user_items[1] - 1)
    return kept if item_users is None else within_band(kept, item, item_users[0] + 1, item_users[1] - 1)


def drop_heavy(df: DataFrame, user: str, item: str, most: int) -> DataFrame:
    """Drop users with more than ``most`` distinct items."""
    heavy = df.groupBy(user).agg(F.count_distinct(item).alias("n")).where(F.col("n") > most).select(user)
    return df.join(heavy, user, "left_anti")


def trim_similar(rows: DataFrame, allow: DataFrame, min_sim: float = 0.87, n: int = 5) -> DataFrame:
    """First n allowed neighbours above the similarity of ``item, value`` rows.

    ``value`` holds ``neighbour&sim`` parts in descending order.
    """
    parts = rows.select("item", F.posexplode(F.filter(F.split("value", ","), lambda x: x != "")).alias("pos", "part"))
    fields = parts.select("item", "pos", F.get(F.split("part", "&"), 0).alias("near"),
                          F.get(F.split("part", "&"), 1).cast("double").alias("sim")).where(F.col("sim") > min_sim)
    kept = fields.join(allow.select(F.col(allow.columns[0]).cast("string").alias("near")), "near", "left_semi")
    from .topn import top_n

    first = top_n(kept, ["item"], [F.asc("pos")], n)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "near")))
    named = first.groupBy("item").agg(F.array_join(F.transform(ordered, lambda s: s["near"]), ",").alias("similar"))
    return rows.select("item").join(named, "item", "left").na.fill("", ["similar"])
