"""Push audiences: who gets a message, and at which hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import hour_of
from ..functions.draws import draw_below, draw_int, uniform
from .topn import top_n

# First and number of random hours, the hour lists of the
# "n hours" audiences, and the most hours per user.
FIRST_HOUR, HOUR_COUNT = 8, 15
SEARCHER_HOURS = (10, 11, 13, 15, 18, 20)
EVERYONE_HOURS = (9, 11, 13, 15, 18, 20)
LAPSED_HOURS = (8, 10, 12, 16, 18, 20)
MOST_HOURS = 6


def search_hours(searches: DataFrame, start: str, end: str) -> DataFrame:
    """``user_id, hour``: hours of day in which a user searched between two dates."""
    return (searches.where(F.col("date").between(start, end))
            .groupBy("user_id", hour_of("time_ms").alias("hour")).agg(F.lit(1).alias("_")).drop("_"))


def searchers(searches: DataFrame, start: str, end: str) -> DataFrame:
    return searches.where(F.col("date").between(start, end)).select("user_id").distinct()


def who(users: DataFrame, condition: Column) -> DataFrame:
    return users.where(condition).select("user_id").distinct()


def week_not_today(searches: DataFrame, users: DataFrame, week: tuple[str, str], yesterday: str, excluded: DataFrame,
                   min_month: int = 2, hours: tuple[int, int] = (8, 23)) -> DataFrame:
    """Hours of users who searched in the week but not yesterday and click in the month, minus the excluded."""
    found = search_hours(searches, *week).where(F.col("hour").between(*hours))
    return (found.join(searchers(searches, yesterday, yesterday), "user_id", "left_anti")
            .join(who(users, F.col("clicks_month") >= min_month), "user_id", "left_semi")
            .join(excluded.select("user_id"), "user_id", "left_anti"))


def week_clickers(searches: DataFrame, users: DataFrame, week: tuple[str, str], excluded: DataFrame, min_week: int = 2,
                  hours: tuple[int, int] = (9, 22)) -> DataFrame:
    """Hours of weekly clickers who searched in the week, minus the excluded."""
    return (search_hours(searches, *week).where(F.col("hour").between(*hours))
            .join(who(users, F.col("clicks_week") >= min_week), "user_id", "left_semi")
            .join(excluded.select("user_id"), "user_id", "left_anti"))


def by_hour(searches: DataFrame, users: DataFrame, month: tuple[str, str], min_week: int = 2) -> DataFrame:
    """Search hours of a month of the weekly clickers."""
    return search_hours(searches, *month).join(who(users, F.col("clicks_week") >= min_week), "user_id", "left_semi")


def search_or_random_hour(searches: DataFrame, users: DataFrame, month: tuple[str, str], seed, min_week: int = 1) -> DataFrame:
    """Weekly clickers at their own search hours, or at one random hour without any."""
    found = search_hours(searches, *month)
    everyone = found.join(who(users, F.col("clicks_week") >= min_week), "user_id", "right")
    return everyone.select("user_id", F.coalesce("hour", random_hour(seed)).alias("hour"))


def random_hour(seed) -> Column:
    return (draw_below(HOUR_COUNT, seed, "user_id") + FIRST_HOUR).cast("int")


def month_not_week(searches: DataFrame, users: DataFrame, month: tuple[str, str], min_month: int = 1, min_week: int = 1) -> DataFrame:
    """Search hours of monthly clickers who are not weekly clickers."""
    clickers = who(users, F.col("clicks_month") >= min_month).join(who(users, F.col("clicks_week") >= min_week), "user_id", "left_anti")
    return search_hours(searches, *month).join(clickers, "user_id", "left_semi")


def without_search(searches: DataFrame, users: DataFrame, month: tuple[str, str], seed, min_month: int = 1) -> DataFrame:
    """Monthly clickers without a search in the month, at a random hour."""
    quiet = who(users, F.col("clicks_month") >= min_month).join(searchers(searches, *month), "user_id", "left_anti")
    return quiet.select("user_id", random_hour(seed).alias("hour"))


def n_hours(users: DataFrame, hours: tuple[int, ...], seed, most: int = MOST_HOURS) -> DataFrame:
    """As many different hours of a fixed list as the user has click days, up to ``most``."""
    slots = users.select("user_id", F.least("click_days_month", F.lit(most)).alias("_n"),
                         F.explode(F.array(*[F.lit(h) for h in hours])).alias("hour"))
    drawn = slots.withColumn("_draw", draw_int(seed, "user_id", "hour"))
    return (top_n(drawn, ["user_id"], [F.asc("_draw"), F.asc("hour")], most, rank="_rank")
            .where(F.col("_rank") <= F.col("_n")).select("user_id", "hour"))


def searchers_n_hours(searches: DataFrame, users: DataFrame, month: tuple[str, str], seed) -> DataFrame:
    active = users.where((F.col("clicks_month") >= 1) & (F.col("click_days_month") >= 1))
    return n_hours(active.join(searchers(searches, *month), "user_id", "left_semi"), SEARCHER_HOURS, seed)


def everyone_n_hours(users: DataFrame, seed) -> DataFrame:
    return n_hours(users.where((F.col("clicks_month") >= 1) & (F.col("click_days_month") >= 1)), EVERYONE_HOURS, seed)


def lapsed_n_hours(searches: DataFrame, users: DataFrame, month: tuple[str, str], seed, min_month: int = 3, most_week: int = 1) -> DataFrame:
    lapsed = users.where((F.col("clicks_month") >= min_month) & (F.col("clicks_week") <= most_week))
    return n_hours(lapsed.join(searchers(searches, *month), "user_id", "left_semi"), LAPSED_HOURS, seed)


def no_search(searches: DataFrame, users: DataFrame, month: tuple[str, str], allow: DataFrame, min_days: int = 2, min_week: int = 2) -> DataFrame:
    """Weekly clickers without a search in the month, and the allow-list."""
    clickers = who(users, (F.col("click_days_week") >= min_days) & (F.col("clicks_week") >= min_week))
    return clickers.join(searchers(searches, *month), "user_id", "left_anti").unionByName(allow.select("user_id"))


def split_audience(users: DataFrame, allow: DataFrame, n: int, seed) -> DataFrame:
    """``part, user_id``: n random parts, the allow-list added to each, no user twice in a part."""
    parts = users.select((F.floor(uniform(seed, "user_id") * n) + 1).cast("int").alias("part"), "user_id")
    added = allow.select(F.explode(F.sequence(F.lit(1), F.lit(n))).alias("part"), "user_id")
    return parts.unionByName(added).distinct()


def running_counts(rows: DataFrame, first: int, last: int) -> DataFrame:
    """``hour, pv, uv``: rows and users from ``first`` up to each hour.

    A user is counted at the first hour they appear, so both are running sums
    over at most 24 rows.
    """
    inside = rows.where(F.col("hour").between(first, last))
    pv = inside.groupBy("hour").agg(F.count("*").alias("pv"))
    uv = inside.groupBy("user_id").agg(F.min("hour").alias("hour")).groupBy("hour").agg(F.count("*").alias("uv"))
    upto = Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hourly = pv.join(uv, "hour", "left").na.fill(0, ["uv"])
    return hourly.select("hour", F.sum("pv").over(upto).alias("pv"), F.sum("uv").over(upto).alias("uv"))
