"""Item sets, behaviour scores and hot, trending, cold-start and fallback lists.

Lists are long rows ``list_id, item, score``; ties go by item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import day_shift
from ..functions.draws import uniform
from ..functions.nested import json_list
from ..functions.numeric import finite, ratio, ucb_log, ucb_sqrt, wilson
from ..session import stored
from .cf import band_keys, within_band
from .filters import FIRST_GAME, activity_band, allow_deny
from .topn import list_of, lists_of, top_n

# Weight of each action in a behaviour score, exposure thresholds,
# score of never exposed items, and the share of active users.
ACTION_WEIGHTS = {"activate": 3, "install": 3, "download_install": 2}
THRESHOLDS = (1, 2, 6, 8)
UNSEEN_SCORE = 10_000.0
ACTIVE_FACTOR = 4


def item_sets(df: DataFrame, user: str, item: str) -> DataFrame:
    """``user, items``: distinct items per user; repeats collapse map-side."""
    return df.groupBy(user).agg(F.collect_set(F.col(item).cast("string")).alias("items"))


def sets_by_action(df: DataFrame, user: str, item: str, groups: dict[str, list[str]], action: str = "action") -> DataFrame:
    """One pass: a set of items per user for every named group of actions."""
    wanted = sorted({a for actions in groups.values() for a in actions})
    member = lambda actions: F.when(F.col(action).isin(actions), F.col(item).cast("string"))
    return df.where(F.col(action).isin(wanted)).groupBy(user).agg(
        *[F.collect_set(member(actions)).alias(name) for name, actions in groups.items()])


def passive_items(log: DataFrame, pages: list[str], packages: list[str], delivery: str, home: str, home_refs: list[str],
                  chooser: list[str], carousel: list[str] = ()) -> DataFrame:
    """``user_id, items`` opened through ads or the app chooser.

    Both branches read the same log, so one filter with OR replaces their union.
    """
    ad = F.col("launch_pkg").isin(packages) & (F.col("launch_ref").startswith(delivery) | F.col("launch_ref").isin(list(carousel)))
    chosen = ((F.col("launch_pkg") == home) & F.col("launch_ref").isin(home_refs)) | F.col("launch_pkg").isin(chooser)
    return item_sets(log.where(F.col("first_page").isin(pages) & (ad | chosen) & F.col("user_id").isNotNull()), "user_id", "item_id")


def exposure_thresholds(log: DataFrame, user: str, item: str, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """``seen_k``: map of the items seen at least k times, to k; null where there are none."""
    counts = log.groupBy(user, item).agg(F.count("*").alias("_n"))

    def seen(k: int) -> Column:
        entries = F.collect_list(F.when(F.col("_n") >= k, F.struct(F.col(item).cast("string"), F.lit(k))))
        return F.when(F.count_if(F.col("_n") >= k) > 0, F.map_from_entries(entries)).alias(f"seen_{k}")

    return counts.groupBy(user).agg(*[seen(k) for k in thresholds])


def group_concat(df: DataFrame, key: str, part: Column, name: str) -> DataFrame:
    """Distinct parts per key as one sorted, comma-joined text."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(part)), ",").alias(name))


def keyword_totals(log: DataFrame) -> DataFrame:
    """Sums per keyword and item as ``user_id, item_id`` and the counts."""
    counts = ("exposure_uv", "click_uv", "download_uv", "install_uv")
    present = F.col("keyword").isNotNull() & (F.col("keyword") != "") & F.col("item_id").isNotNull()
    return (log.where(present).groupBy(F.col("keyword").alias("user_id"), F.col("item_id").cast("string").alias("item_id"))
            .agg(*[F.sum(c).alias(c) for c in counts]))


# Weights of the click, download and install share of a keyword score.
CLICK_WEIGHT, DOWNLOAD_WEIGHT, INSTALL_WEIGHT = 10, 50, 100


def keyword_scores(log: DataFrame, kind: str, times: float = 1, users: tuple | None = None, items: tuple | None = None) -> DataFrame:
    """``user_id, item_id, score`` with keywords in the place of users.

    ``wilson``: lower bound of downloads per exposure, no bands. ``downloads``:
    download count, keywords banded first and items on what is left. ``weighted``:
    weighted bounds of clicks, downloads and installs, both bands on all rows.
    ``times`` scales the score; ``users`` and ``items`` are open bands, off by default.
    """
    totals = keyword_totals(log)
    if kind == "wilson":
        score = wilson("download_uv", "exposure_uv")
        return totals.select("user_id", "item_id", score.alias("score")).where(F.col("score") != 0)
    if kind == "downloads":
        rows = totals.select("user_id", "item_id", (F.col("download_uv") * times).cast("double").alias("score"))
        return activity_band(rows, "user_id", "item_id", users, items).where(F.col("score") > 0)
    if kind == "weighted":
        score = (wilson("click_uv", "exposure_uv") * CLICK_WEIGHT + wilson("download_uv", "exposure_uv") * DOWNLOAD_WEIGHT
                 + wilson("install_uv", "exposure_uv") * INSTALL_WEIGHT) * times
        rows = totals.select("user_id", "item_id", score.alias("score")).where(F.col("score") > 0)
        return _both_bands(rows, users, items)
    raise ValueError(f"unknown keyword score {kind}")


def _both_bands(rows: DataFrame, users: tuple | None, items: tuple | None, distinct: bool = False) -> DataFrame:
    """Open bands for users and items where given, both judged on all rows."""
    kept = rows
    for key, other, band in (("user_id", "item_id", users), ("item_id", "user_id", items)):
        if band is not None:
            kept = kept.join(band_keys(rows, key, band[0] + 1, band[1] - 1, other if distinct else None), key, "left_semi")
    return kept.select(*rows.columns)


def keyword_scores_sampled(log: DataFrame, crowded: int, fraction: float, times: float = 1,
                           users: tuple | None = None, seed=42) -> DataFrame:
    """Download scores where items with more than ``crowded`` keywords keep a seeded sample of their rows."""
    rows = keyword_totals(log).select("user_id", "item_id", (F.col("download_uv") * times).cast("double").alias("score"))
    heavy = band_keys(rows, "item_id", crowded + 1)
    sampled = rows.join(heavy, "item_id", "left_semi").where(uniform(seed, "user_id", "item_id") < fraction)
    return (_both_bands(rows, users, (1, crowded)).unionByName(sampled.select(*rows.columns))
            .groupBy("user_id", "item_id").agg(F.sum("score").alias("score")).where(F.col("score") > 0))


def _weight(weights: dict[str, int]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("action"))


def daily_actions(log: DataFrame, weights: dict[str, int]) -> DataFrame:
    """One row per user, item, scored action and date."""
    return log.where(F.col("action").isin(list(weights))).select("user_id", "item_id", "action", "date").distinct()


def _score_rows(rows: DataFrame, score: Column) -> DataFrame:
    return (rows.groupBy("user_id", "item_id").agg(F.sum(score).cast("double").alias("score"))
            .select("user_id", F.col("item_id").cast("string").alias("item_id"), "score").where(F.col("score") > 0))


def behaviour_scores(log: DataFrame, weights: dict[str, int], users: tuple | None = None, items: tuple | None = None) -> DataFrame:
    """``user_id, item_id, score``: weights of the daily actions, users banded by distinct items, then items by distinct users."""
    rows = daily_actions(log, weights)
    if users is not None:
        rows = within_band(rows, "user_id", users[0] + 1, users[1] - 1, distinct="item_id")
    if items is not None:
        rows = within_band(rows, "item_id", items[0] + 1, items[1] - 1, distinct="user_id")
    return _score_rows(rows, _weight(weights))


def behaviour_scores_active(log: DataFrame, flags: DataFrame, weights: dict[str, int], users: tuple | None = None,
                            items: tuple | None = None, id_length: int | None = None) -> DataFrame:
    """As :func:`behaviour_scores` with active users counted four times and passive users once.

    ``flags`` holds ``user_id, is_active, is_passive``. With ``id_length``, users
    whose id has another length count as passive.
    """
    rows = daily_actions(log, weights)
    rows = _both_bands(rows, users, items, distinct=True).join(flags, "user_id", "left")
    proper = F.lit(True) if id_length is None else F.length("user_id") == id_length
    active = F.coalesce(F.col("is_active") == 1, F.lit(False)) & proper
    passive = F.coalesce(F.col("is_passive") == 1, F.lit(False)) | ~proper
    factor = F.when(active, ACTIVE_FACTOR).when(passive, 1).otherwise(0)
    return _score_rows(rows, _weight(weights) * factor)


def item_users(log: DataFrame, action: str, name: str = "score", allow: DataFrame | None = None, deny: DataFrame | None = None) -> DataFrame:
    """``item_id`` and its number of distinct users with the action."""
    rows = allow_deny(log.where(F.col("action") == action), "item_id", allow, deny)
    return rows.groupBy("item_id").agg(F.count_distinct("user_id").alias(name))


def _is_game() -> Column:
    return F.col("category_id") >= FIRST_GAME


def hot_in_rec(log: DataFrame, catalog: DataFrame, allow: DataFrame, n: int = 200, version: str = "", action: str = "download_install",
               categories: int = 13) -> DataFrame:
    """Hot apps, games and categories by user-days with a download."""
    per_item = (log.where(F.col("action") == action).select("user_id", "item_id", "date").distinct()
                .groupBy("item_id").agg(F.count("*").alias("score")))
    scored = allow_deny(per_item.join(catalog.select("item_id", "category_id"), "item_id"), "item_id", allow)
    rows = scored.where(F.col("category_id") > 0).select(
        F.concat(F.when(_is_game(), "hot_games").otherwise("hot_apps"), F.lit(version)).alias("list_id"),
        F.col("item_id").cast("string").alias("item"), F.col("score").cast("double").alias("score"))
    by_category = scored.groupBy("category_id").agg(F.sum("score").alias("score"))
    return lists_of(rows, n).unionByName(list_of(by_category, f"hot_categories{version}", "category_id", "score", categories))


def hot_in_search(log: DataFrame, allow: DataFrame, n: int = 100, version: str = "") -> DataFrame:
    """Most seen, downloaded and clicked items in search, and the union of the first two with score 1.

    One user counts once per day, keyword, item and action.
    """
    names = {"item_exposure": "top_exposed", "download_install": "top_downloaded", "item_click": "top_clicked"}
    rows = log.where(F.col("action").isin(list(names)) & F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    counts = (allow_deny(rows.select("user_id", "keyword", "item_id", "action", "date").distinct(), "item_id", allow)
              .groupBy("action", "item_id").agg(F.count("*").cast("double").alias("score")))
    label = reduce(lambda c, kv: c.when(F.col("action") == kv[0], kv[1] + version), names.items(), F.when(F.lit(False), ""))
    top = lists_of(counts.select(label.alias("list_id"), F.col("item_id").cast("string").alias("item"), "score"), n)
    shown = top.where(F.col("list_id").isin(f"top_exposed{version}", f"top_downloaded{version}"))
    union = shown.select(F.lit(f"top_items{version}").alias("list_id"), "item", F.lit(1.0).alias("score")).distinct()
    return top.unionByName(union)


def supplement_lists(catalog: DataFrame, scores: DataFrame, levels: list[str], n: int = 1000) -> DataFrame:
    """Fallback lists per locale, and per locale with category, tag, game, app and known developer.

    Every item is exploded to the lists it belongs to once, then cut per list.
    Items without a score get 0.
    """
    base = (catalog.where(F.col("level").isin(levels)).join(scores, "item_id", "left")
            .withColumn("score", F.coalesce(F.col("score"), F.lit(0)).cast("double")))
    tags = F.transform(F.coalesce(json_list("tagids"), F.array().cast("array<string>")), lambda x: F.concat(F.lit("tag_"), x))
    kinds = F.concat(F.array(F.lit(""), F.concat(F.lit("category_"), F.col("category_id").cast("string")),
                             F.when(_is_game(), "game"), F.when((F.col("category_id") > 0) & ~_is_game(), "app"),
                             F.when(F.col("developer_id") > 0, "dev")), tags)
    rows = base.select("locale", F.col("item_id").cast("string").alias("item"), "score", F.explode(kinds).alias("kind"))
    list_id = F.concat_ws("_", F.lit("supplement"), "locale", F.nullif("kind", F.lit("")))
    return lists_of(rows.where(F.col("kind").isNotNull()).select(list_id.alias("list_id"), "item", "score").distinct(), n)


def _downloads_by_class(log: DataFrame, classes: DataFrame, allow: DataFrame, actions: list[str]) -> DataFrame:
    """User-days with a download per class and item; ``classes`` holds ``item_id, class``."""
    rows = log.where(F.col("action").isin(actions)).select("user_id", "item_id", "date")
    return (allow_deny(rows, "item_id", allow).distinct().join(classes, "item_id").groupBy("class", "item_id")
            .agg(F.count("*").cast("double").alias("score")))


def hot_in_class(log: DataFrame, classes: DataFrame, allow: DataFrame, prefix: str, n: int = 200,
                 actions: list[str] = ("download_install",)) -> DataFrame:
    """The n most downloaded items of every class; list id is prefix and class."""
    rows = _downloads_by_class(log, classes, allow, list(actions))
    return lists_of(rows.select(F.concat(F.lit(prefix), F.col("class").cast("string")).alias("list_id"),
                                F.col("item_id").cast("string").alias("item"), "score"), n)


def hot_classes(log: DataFrame, classes: DataFrame, allow: DataFrame, name: str, n: int = 100,
                actions: list[str] = ("download_install",)) -> DataFrame:
    """The n most downloaded classes."""
    rows = _downloads_by_class(log, classes, allow, list(actions)).groupBy("class").agg(F.sum("score").alias("score"))
    return list_of(rows, name, "class", "score", n)


def hot_where_json(log: DataFrame, items: DataFrame, column: str, path: str, value: str, name: str, action: str, n: int = 200,
                   allow: DataFrame | None = None) -> DataFrame:
    """Top items by users among those whose JSON text has the value at the path."""
    fitting = items.where(F.get_json_object(column, path) == value).select("item_id").distinct()
    counts = item_users(log, action, allow=fitting)
    return list_of(allow_deny(counts, "item_id", allow), name, "item_id", "score", n)


def trending(log: DataFrame, day: str, before: tuple[str, str], days: int, rate: float, action: str = "activate",
             floor_today: int = 500, floor_before: int = 500, allow: DataFrame | None = None) -> DataFrame:
    """``item_id, ratio``: users today over the daily mean before, at least 1 + rate.

    Both windows are counted in one pass. Items need ``floor_today`` users today
    and more than ``floor_before`` in the window before.
    """
    today, earlier = F.col("date") == day, F.col("date").between(*before)
    rows = allow_deny(log.where((F.col("action") == action) & (today | earlier)), "item_id", allow)
    users = rows.groupBy("item_id", "user_id").agg(F.max(today.cast("int")).alias("t"), F.max(earlier.cast("int")).alias("b"))
    counts = users.groupBy("item_id").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
    return (counts.where((F.col("t") >= floor_today) & (F.col("b") > floor_before))
            .select("item_id", (F.col("t") / (F.col("b") / days)).alias("ratio")).where(F.col("ratio") >= 1 + rate))


def trending_days(log: DataFrame, days: list[str], before: int, rate: float, action: str = "activate", floor_today: int = 500,
                  floor_before: int = 500, allow: DataFrame | None = None) -> DataFrame:
    """``date, item_id, ratio``: :func:`trending` on each of several days, from one scan of the log.

    The users of a sliding window are counted by gaps: a user's active day brings the user into the windows that end on
    it and on the days after, until ``before`` days have passed or the user's next active day takes over. That is one +1 and
    one -1 for each active day; running sums over an item's days give the distinct users of every window.
    """
    first, last = min(days), max(days)
    number = F.unix_date(F.to_date("date", "yyyyMMdd"))
    rows = log.where((F.col("action") == action) & (F.col("date") <= last) & (F.col("date") >= F.lit(day_shift(first, -before))))
    active = allow_deny(rows, "item_id", allow).select("user_id", "item_id", number.alias("day")).distinct()
    following = F.lead("day").over(Window.partitionBy("user_id", "item_id").orderBy("day"))
    out = F.least(F.col("day") + before, F.coalesce(following, F.col("day") + before))
    change = F.explode(F.array(F.struct(F.col("day").alias("d"), F.lit(1).alias("step"), F.lit(1).alias("here")),
                               F.struct(F.col("out").alias("d"), F.lit(-1).alias("step"), F.lit(0).alias("here"))))
    steps = (active.withColumn("out", out).select("item_id", change.alias("c")).groupBy("item_id", "c.d")
             .agg(F.sum("c.step").alias("step"), F.sum("c.here").alias("t")))
    earlier = Window.partitionBy("item_id").orderBy("d").rowsBetween(Window.unboundedPreceding, -1)
    counts = steps.withColumn("b", F.coalesce(F.sum("step").over(earlier), F.lit(0)))
    date = F.date_format(F.date_from_unix_date("d"), "yyyyMMdd")
    return (counts.withColumn("date", date).where(F.col("date").isin(days) & (F.col("t") >= floor_today) & (F.col("b") > floor_before))
            .select("date", "item_id", (F.col("t") / (F.col("b") / before)).alias("ratio")).where(F.col("ratio") >= 1 + rate))


def merge_lists(history: DataFrame, today: DataFrame, name: str, how: str = "max", n: int | None = 200) -> DataFrame:
    """Today's list with earlier ones, the best (``max``) or the summed (``sum``) score per item."""
    combine = F.max("score") if how == "max" else F.sum("score")
    merged = today.select("item", "score").unionByName(history.select("item", "score")).groupBy("item").agg(combine.alias("score"))
    return merged.select(F.lit(name).alias("list_id"), "item", "score") if n is None else list_of(merged, name, "item", "score", n)


def cold_start(log: DataFrame, pool: DataFrame, name: str, n: int = 200, formula: str = "log", home: str = "recommend",
               status: str = "download_request", installs: tuple[str, ...] = ("manual_install", "auto_install"),
               scale: float = 10, only_logged: bool = False) -> DataFrame:
    """Cold-start lists by an upper confidence bound of downloads per exposed user, the n best of each list.

    ``pool`` holds ``item_id`` and, for several lists at once, ``list_id`` behind ``name``; every list has its own
    totals. Items above their list's overall rate stay; never exposed items come first with a fixed score. The mean
    exposure is divided by ``scale``, which brings both terms of the bound to one order of magnitude. ``only_logged``
    leaves out items that the log doesn't hold. The log is read once, into one row per list, item and user.
    """
    label = F.concat_ws("_", F.lit(name), F.col("list_id").cast("string")) if "list_id" in pool.columns else F.lit(name)
    pool = pool.select(label.alias("list_id"), "item_id").distinct()
    shown = (F.col("page") == home) & (F.col("action") == "item_exposure")
    loaded = (F.col("page").contains("detail") & (F.col("action") == "download_install")
              & (F.col("install_status") == status) & F.col("install_type").isin(*installs))
    folded = stored(log.join(pool, "item_id").groupBy("list_id", "item_id", "user_id").agg(
        F.max(F.coalesce(shown, F.lit(False)).cast("int")).alias("s"), F.max(F.coalesce(loaded, F.lit(False)).cast("int")).alias("d")), "folded")
    per_item = folded.groupBy("list_id", "item_id").agg(F.sum("s").alias("seen"), F.sum("d").alias("got"))
    counted = pool.join(per_item, ["list_id", "item_id"], "inner" if only_logged else "left").na.fill(0, ["seen", "got"])
    users = folded.where("s = 1").groupBy("list_id", "user_id").agg(F.lit(1).alias("one")).groupBy("list_id").agg(F.count("*").alias("users"))
    totals = (counted.groupBy("list_id").agg(F.count("*").alias("size"), F.sum("got").alias("all_got")).join(users, "list_id", "left"))
    mean = F.try_divide(F.col("users"), F.col("size")) / scale
    overall = F.coalesce(F.try_divide(F.col("all_got"), F.col("users")), F.lit(-1.0))
    bound = (ucb_log if formula == "log" else ucb_sqrt)(ratio("got", "seen"), mean, F.col("seen"))
    scored = counted.join(totals, "list_id").withColumn("score", F.when(F.col("seen") == 0, F.lit(UNSEEN_SCORE)).when(F.col("got") > 0, bound))
    # Below a mean exposure of 1 the square root has no value: such items carry no score.
    kept = scored.where(finite("score") & ((F.col("seen") == 0) | (F.col("score") > overall)))
    return lists_of(kept.select("list_id", F.col("item_id").cast("string").alias("item"), F.col("score").cast("double").alias("score")), n)


def no_recall(catalog: DataFrame, recalled: DataFrame, scores: DataFrame, level: str, name: str, by_category: bool = False) -> DataFrame:
    """Scored items of a level that no other channel returned, per level or per level and category."""
    rows = catalog.where(F.col("level") == level).join(recalled.select("item_id"), "item_id", "left_anti").join(scores, "item_id")
    parts = [F.lit(name), F.col("level")] + ([F.col("category_id").cast("string")] if by_category else [])
    return rows.select(F.concat_ws("_", *parts).alias("list_id"), F.col("item_id").cast("string").alias("item"),
                       F.col("score").cast("double").alias("score"))


def recalled_items(channels: DataFrame, own_channel: str) -> DataFrame:
    """Items returned by more than one channel, or by another one than ``own_channel``."""
    other = (F.size("channels") > 1) | (F.col("channels")[0] != own_channel)
    return channels.where(other).select("item_id").distinct()


def sum_lists(lists: DataFrame) -> DataFrame:
    """Daily lists added up per list and item."""
    return lists.groupBy("list_id", "item").agg(F.sum("score").alias("score"))


def user_class_rate(log: DataFrame, classes: DataFrame, shown: str = "item_exposure", clicked: str = "item_click") -> DataFrame:
    """``user_id, class, score``: Wilson bound of daily clicks per daily exposures, exposures starting at 1."""
    days = log.where(F.col("action").isin(shown, clicked)).select("user_id", "item_id", "action", "date").distinct()
    per_item = days.groupBy("user_id", "item_id").agg(
        F.count_if(F.col("action") == shown).alias("e"), F.count_if(F.col("action") == clicked).alias("c"))
    sums = per_item.join(classes, "item_id").groupBy("user_id", "class").agg(
        (F.sum("e") + 1).alias("e"), F.sum("c").alias("c"))
    # More clicks than exposures give no valid share: such pairs are not scored.
    bound = F.when(F.col("c") <= F.col("e"), wilson("c", "e"))
    return sums.select("user_id", "class", bound.alias("score")).where(F.col("score") > 0)


def user_class_counts(log: DataFrame, classes: DataFrame, action: str = "install") -> DataFrame:
    rows = log.where(F.col("action") == action).join(classes, "item_id")
    return rows.groupBy("user_id", "class").agg(F.count("*").cast("double").alias("score"))


def favourite_categories(scores: DataFrame, n: int = 10) -> DataFrame:
    """The n best game and the n best app categories of every user: ``user_id, kind, class, score``."""
    kinds = scores.withColumn("kind", F.when(F.col("class") >= FIRST_GAME, "game").otherwise("app"))
    return top_n(kinds, ["user_id", "kind"], [F.desc("score"), F.asc("class")], n, rank=None)


def favourite_classes(scores: DataFrame, n: int = 100) -> DataFrame:
    return top_n(scores, ["user_id"], [F.desc("score"), F.asc("class")], n, rank=None)


def weighted_categories(log: DataFrame, classes: DataFrame, n: int, views: tuple[str, ...] = ("item_click", "download_install"),
                        installs: tuple[str, ...] = ("install",), downloads: tuple[str, ...] = ("download_install",),
                        most_downloads: int | None = None) -> DataFrame:
    """``user_id, class, score``: views / 4 + installs / 2, the n best per user.

    With ``most_downloads``, users need a day with at most so many downloaded items.
    """
    rows = log if most_downloads is None else _with_modest_day(log, downloads, most_downloads)
    rows = rows.join(classes, "item_id")
    score = F.count_if(F.col("action").isin(*views)) / 4 + F.count_if(F.col("action").isin(*installs)) / 2
    return favourite_classes(rows.groupBy("user_id", "class").agg(score.alias("score")), n)


def _with_modest_day(log: DataFrame, downloads: tuple[str, ...], most: int) -> DataFrame:
    sane = (log.where(F.col("action").isin(*downloads)).groupBy("user_id", "date").agg(F.count_distinct("item_id").alias("_n"))
            .where(F.col("_n") <= most).select("user_id").distinct())
    return log.join(sane, "user_id", "left_semi")


def top_usage(usage: DataFrame, n: int = 10) -> DataFrame:
    """``user_id, item_id, score, rank``: 5 · mean duration + 3 · mean frequency, the n best per user."""
    means = usage.groupBy("user_id", "item_id").agg(F.avg("frequency").alias("f"), F.avg("duration").alias("d"))
    valid = F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & (F.col("f") > 0) & (F.col("d") > 0)
    scored = means.where(valid).select("user_id", "item_id", (5 * F.col("d") + 3 * F.col("f")).alias("score"))
    return top_n(scored, ["user_id"], [F.desc("score"), F.asc("item_id")], n)


def knn_rows_to_lists(rows: DataFrame, n: int = 100, base: float = 100.0, max_distance: float | None = None,
                      allow: DataFrame | None = None) -> DataFrame:
    """``id, item, score, rank`` from ``id, distance, item`` rows: score base − distance, no item with itself."""
    kept = rows.where(F.col("id") != F.col("item"))
    if max_distance is not None:
        kept = kept.where(F.col("distance") <= max_distance)
    scored = allow_deny(kept.select("id", "item", (F.lit(base) - F.col("distance")).alias("score")), "item", allow)
    return top_n(scored, ["id"], [F.desc("score"), F.asc("item")], n)


# Prefix and length of a hot query's catalog id, its title and where it is available.
QUERY_PREFIX, QUERY_ID_LENGTH = "bs_", 17
QUERY_TITLE, QUERY_AVAILABILITY = "全网热搜", "browser"


def query_id(source_id: Column) -> Column:
    return F.substring(F.concat(F.lit(QUERY_PREFIX), source_id), 1, QUERY_ID_LENGTH)


def project_hot_queries(queries: DataFrame) -> DataFrame:
    """The source columns as ``org_*`` text, and the catalog's own columns of a hot query."""
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.S")
    day = lambda c: F.date_format(c, "yyyyMMdd")
    plain = ("id", "name", "source", "image_url", "abstract", "type", "category", "position", "status")
    return queries.select(
        *[F.col(c).cast("string").alias(f"org_{c}") for c in plain],
        stamp("create_time").alias("org_create_time"), stamp("update_time").alias("org_update_time"),
        F.col("show_title").cast("string").alias("org_show_title"), query_id(F.col("id").cast("string")).alias("id"),
        F.lit(QUERY_TITLE).alias("title"), F.col("name").alias("subtitle"), F.lit("").alias("url"),
        day("create_time").alias("create_time_date"), day("update_time").alias("update_time_date"),
        F.lit(QUERY_AVAILABILITY).alias("availability"))
