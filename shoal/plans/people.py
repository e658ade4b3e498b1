"""User profiles, flags and push audiences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audience, hot, profiles, sampling
from ..session import scratch_path
from ..sources import sinks
from .base import joined, query
from .inputs import NEW_SNAPSHOT
from .sqltext import define, draw, u01
from .toplists import usage

_MONTH, _WEEK, _YESTERDAY = ("20240101", "20240130"), ("20240124", "20240129"), "20240130"


def _set(cond: str) -> str:
    return f"string_agg(DISTINCT CAST(t.item_id AS VARCHAR), ',' ORDER BY CAST(t.item_id AS VARCHAR)) FILTER ({cond})"


_CLICK = "action = 'item_click' AND date BETWEEN '20240101' AND '20240130'"
_DOWN = "action = 'download_install' AND date BETWEEN '20240110' AND '20240130'"
_INST = "action = 'install' AND date BETWEEN '20240115' AND '20240130'"
_ACT = "action = 'activate' AND date BETWEEN '20240120' AND '20240130'"
_GAME, _APP = "class >= 100", "class BETWEEN 0 AND 99"
_SETS = {"click": _CLICK, "click_app": f"{_CLICK} AND {_APP}", "click_game": f"{_CLICK} AND {_GAME}", "download": _DOWN,
         "download_app": f"{_DOWN} AND {_APP}", "download_game": f"{_DOWN} AND {_GAME}", "install": _INST, "activate": _ACT,
         "click_download_app": f"(({_CLICK}) OR ({_DOWN})) AND {_APP}", "click_download_game": f"(({_CLICK}) OR ({_DOWN})) AND {_GAME}"}


def _profile(t):
    starts = {"click": "20240101", "download": "20240110", "install": "20240115", "activate": "20240120"}
    actions = {"click": ["item_click"], "download": ["download_install"], "install": ["install"], "activate": ["activate"]}
    return profiles.behaviour_profile(t.track(), t.latest_catalog(), starts, "20240130", actions)


@query("user_behaviour_profile", f"""SELECT user_id, {', '.join(f'{_set(c)} AS {n}' for n, c in _SETS.items())}
    FROM track t LEFT JOIN category_map l ON t.item_id = l.item_id WHERE ({_CLICK}) OR ({_DOWN}) OR ({_INST}) OR ({_ACT}) GROUP BY user_id""", "track category_map")
def _(t):
    return _profile(t).select("user_id", *[F.when(F.col(n).isNotNull(), joined(n, n)).alias(n) for n in _SETS])


@query("user_platform_profile", """WITH p AS (SELECT user_id,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) FILTER (action = 'download_install') AS download,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) FILTER (action = 'install' AND date >= '20240124') AS install,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) FILTER (action = 'activate' AND date >= '20240124') AS activate
        FROM track WHERE action = 'download_install' OR (action IN ('install', 'activate') AND date >= '20240124') GROUP BY user_id),
    u AS (SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY round(score, 9) DESC, item_id) AS used FROM usage_scores GROUP BY user_id)
    SELECT user_id, download, install, activate, used FROM p FULL JOIN u USING (user_id)""", "track usage_scores")
def _(t):
    rows = profiles.platform_profile(t.track(), _MONTH, ("20240124", "20240130"), hot.top_usage(usage(t)))
    text = lambda c: F.when(F.col(c).isNotNull(), joined(c, c)).alias(c)
    return rows.select("user_id", text("download"), text("install"), text("activate"), F.array_join("used", ",").alias("used"))


_LAUNCH = "((launch_ref IS NOT NULL AND launch_ref <> '' AND launch_ref <> 'update') OR page_ref = 'miniCard')"
_LAUNCH_ARGS = {"ignored": ["update"], "page_refs": ["miniCard"]}
define("glide", "track", f"""SELECT user_id, CASE WHEN p >= 3 THEN 1 ELSE 0 END AS is_glide, CASE WHEN p < 3 THEN 1 ELSE 0 END AS is_not_glide
    FROM (SELECT user_id, max(CASE WHEN card_type = 'recApps' THEN card_pos ELSE 0 END) AS p FROM track WHERE date = '20240130' AND {_LAUNCH} GROUP BY user_id)""")
define("tier", "track", f"""SELECT user_id, CASE WHEN s < 6 THEN 1 ELSE 0 END AS is_light, CASE WHEN s BETWEEN 6 AND 20 THEN 1 ELSE 0 END AS is_middle,
    CASE WHEN s > 20 THEN 1 ELSE 0 END AS is_heavy FROM (SELECT user_id, sum(CASE WHEN action = 'item_exposure' THEN value * 100 ELSE 0 END) / 1000 AS s
    FROM track WHERE date BETWEEN '20240124' AND '20240130' AND {_LAUNCH} GROUP BY user_id)""")
define("active", "track", f"""SELECT user_id, CASE WHEN o = 1 THEN 1 END AS is_active, CASE WHEN o <> 1 THEN 1 END AS is_passive FROM (SELECT user_id,
    max(CASE WHEN launch_ref = 'home' THEN 1 ELSE 0 END) AS o FROM track WHERE date = '20240130' AND {_LAUNCH} GROUP BY user_id)""")
define("levels", "track", """SELECT user_id, CASE WHEN n > 70 THEN 'high' WHEN n > 60 THEN 'mid' ELSE 'low' END AS level
    FROM (SELECT user_id, count(*) AS n FROM track GROUP BY user_id)""")
define("level_flags", "levels", """SELECT user_id, max(CASE WHEN level = 'high' THEN 1 END) AS usage_high, max(CASE WHEN level = 'mid' THEN 1 END) AS usage_mid,
    max(CASE WHEN level = 'low' THEN 1 END) AS usage_low FROM levels GROUP BY user_id""")


def _today(t):
    return t.track().where(F.col("date") == NEW_SNAPSHOT)


def _glide(t):
    return profiles.glide_flags(_today(t), **_LAUNCH_ARGS)


def _tier(t):
    week = t.track().where(F.col("date").between("20240124", "20240130"))
    return profiles.duration_tiers(week, action="item_exposure", duration_ms=F.col("value") * 100, **_LAUNCH_ARGS)


def _active(t):
    return profiles.active_flags(_today(t), home="home", **_LAUNCH_ARGS)


def _levels(t):
    counts = t.track().groupBy("user_id").agg(F.count("*").alias("n"))
    return counts.select("user_id", F.when(F.col("n") > 70, "high").when(F.col("n") > 60, "mid").otherwise("low").alias("level"))


@query("user_glide_flag", "SELECT * FROM glide", "glide")
def _(t):
    return _glide(t)


@query("user_duration_tier", "SELECT * FROM tier", "tier")
def _(t):
    return _tier(t)


@query("user_active_flag", "SELECT user_id, coalesce(is_active, 0) AS is_active, coalesce(is_passive, 0) AS is_passive FROM active", "active")
def _(t):
    return _active(t).na.fill(0)


@query("user_level_flags", """SELECT user_id, coalesce(usage_high, 0) AS usage_high, coalesce(usage_mid, 0) AS usage_mid,
    coalesce(usage_low, 0) AS usage_low FROM level_flags""", "level_flags")
def _(t):
    return profiles.level_flags(_levels(t), "usage").na.fill(0)


@query("user_game_flag", """SELECT user_id, 1 AS is_game_user FROM track WHERE item_id IN (SELECT item_id FROM latest WHERE category_id >= 100)
    GROUP BY user_id HAVING avg(hour + 1) >= 13 OR avg(value) >= 60""", "track latest")
def _(t):
    return profiles.game_flags(usage(t), t.latest_catalog(), 13, 60)


@query("user_sensitive", """SELECT user_id, 1 AS is_sensitive, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM track
    WHERE ((action = 'item_click') OR (action = 'download_install' AND date >= '20240110') OR (action = 'install' AND date >= '20240115'))
    AND item_id IN (SELECT item_id FROM denied) GROUP BY user_id""", "track denied")
def _(t):
    found = profiles.sensitive_users(_profile(t), ["click", "download", "install"], t.denied_items())
    return found.select("user_id", "is_sensitive", joined("items", "items"))


_FLAGS = ", ".join(f"coalesce({c}, -1) AS {c}" for c in ("is_glide", "is_not_glide", "is_light", "is_middle", "is_heavy", "is_active",
                                                          "is_passive", "usage_high", "usage_mid", "usage_low"))


@query("user_hierarchy", f"""SELECT user_id, {_FLAGS}
    FROM glide FULL JOIN tier USING (user_id) FULL JOIN active USING (user_id) FULL JOIN level_flags USING (user_id)""", "glide tier active level_flags")
def _(t):
    n = F.col("n")
    flags = profiles.hierarchy(t.track(), NEW_SNAPSHOT, ("20240124", "20240130"), "home", "item_exposure", F.col("value") * 100,
                               levels={"high": n > 70, "mid": n > 60, "low": F.lit(True)}, prefix="usage", **_LAUNCH_ARGS)
    return flags.na.fill(-1)


@query("user_features", """WITH a AS (SELECT user_id, CASE WHEN clicks_week > 1 THEN 'v3' ELSE 'v6' END AS audience FROM push_users),
    f AS (SELECT CAST(2 * CAST(id AS BIGINT) AS VARCHAR) AS user_id, label, vector FROM vectors)
    SELECT user_id, audience, CAST(coalesce(label, -1) AS INTEGER) AS label, CAST(coalesce(len(vector), 64) AS INTEGER) AS size, round(coalesce(list_sum(vector), 0), 4) AS total
    FROM a FULL JOIN f USING (user_id)""", "push_users vectors")
def _(t):
    audiences = t.push_users().select("user_id", F.when(F.col("clicks_week") > 1, "v3").otherwise("v6").alias("audience"))
    # All vectors, given to every other user, so that half of the users have none.
    features = t.table("embeddings").select(
        (F.col("vec_id") * 2).cast("string").alias("user_id"), "label", F.col("embedding").cast("array<double>").alias("vector"))
    rows = profiles.user_features(audiences, features, ["vector"], 64)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return rows.select("user_id", "audience", F.coalesce("label", F.lit(-1)).alias("label"), F.size("vector").alias("size"), F.round(total, 4).alias("total"))


define("month_hours", "search_hours", "SELECT DISTINCT user_id, hour FROM search_hours WHERE date BETWEEN '20240101' AND '20240130'")
define("week_hours", "search_hours", "SELECT DISTINCT user_id, hour FROM search_hours WHERE date BETWEEN '20240124' AND '20240129'")
define("month_searchers", "searches", "SELECT DISTINCT user_id FROM searches WHERE date BETWEEN '20240101' AND '20240130'")


@query("audience_week_not_today", """SELECT user_id, hour FROM week_hours WHERE hour BETWEEN 8 AND 23
    AND user_id NOT IN (SELECT user_id FROM searches WHERE date = '20240130') AND user_id IN (SELECT user_id FROM push_users WHERE clicks_month >= 2)
    AND user_id NOT IN (SELECT user_id FROM excluded_users)""", "week_hours push_users excluded_users")
def _(t):
    return audience.week_not_today(t.searches(), t.push_users(), _WEEK, _YESTERDAY, t.excluded_users())


@query("audience_week_sampled", f"""SELECT user_id, hour FROM (SELECT DISTINCT user_id, hour FROM search_hours WHERE date BETWEEN '20240124' AND '20240130') WHERE hour BETWEEN 9 AND 22
    AND user_id IN (SELECT user_id FROM push_users WHERE clicks_week >= 2) AND user_id NOT IN (SELECT user_id FROM excluded_users)
    AND {u01('tenth', 'user_id', 'hour')} < 0.1""", "search_hours push_users excluded_users")
def _(t):
    rows = audience.week_clickers(t.searches(), t.push_users(), ("20240124", "20240130"), t.excluded_users())
    return sampling.hash_sample(rows, 0.1, "tenth", "user_id", "hour")


@query("audience_by_hour", """SELECT 'search-v3-' || hour || '30' AS package, user_id FROM month_hours WHERE hour BETWEEN 8 AND 22
    AND user_id IN (SELECT user_id FROM push_users WHERE clicks_week > 1)""", "month_hours push_users")
def _(t):
    rows = audience.by_hour(t.searches(), t.push_users(), _MONTH).where(F.col("hour").between(8, 22))
    path = scratch_path(t.spark, "audience")
    package = F.concat(F.lit("search-v3-"), F.col("hour").cast("string"), F.lit("30"))
    sinks.overwrite_partitions(rows.select("user_id", package.alias("package")), path, ["package"])
    return t.spark.read.parquet(path).select("package", "user_id")


@query("audience_search_or_random_hour", f"""WITH p AS (SELECT user_id FROM push_customers WHERE clicks_week >= 3),
    a AS (SELECT p.user_id, coalesce(h.hour, CAST(floor({u01('hour', 'p.user_id')} * 15) + 8 AS INTEGER)) AS hour FROM p LEFT JOIN
        (SELECT DISTINCT user_id, hour FROM search_hours WHERE date BETWEEN '20240101' AND '20240130') h ON p.user_id = h.user_id)
    SELECT user_id, hour FROM a WHERE {u01('share', 'user_id', 'hour')} < 0.5""", "push_customers search_hours")
def _(t):
    rows = audience.search_or_random_hour(t.searches(), t.push_customers(), _MONTH, "hour", min_week=3)
    return sampling.hash_sample(rows, 0.5, "share", "user_id", "hour")


_NOT_WEEK = """SELECT user_id, hour FROM month_hours WHERE user_id IN (SELECT user_id FROM push_users WHERE clicks_month >= {m})
    AND user_id NOT IN (SELECT user_id FROM push_users WHERE clicks_week >= {w})"""


@query("audience_month_not_week", _NOT_WEEK.format(m=1, w=2), "month_hours push_users")
def _(t):
    return audience.month_not_week(t.searches(), t.push_users(), _MONTH, 1, 2)


@query("audience_month_not_week_v9", _NOT_WEEK.format(m=3, w=3), "month_hours push_users")
def _(t):
    return audience.month_not_week(t.searches(), t.push_users(), _MONTH, 3, 3)


@query("audience_random_hour", f"""SELECT user_id, CAST(floor({u01('lonely', 'user_id')} * 15) + 8 AS INTEGER) AS hour FROM push_customers WHERE clicks_month > 0
    AND user_id NOT IN (SELECT user_id FROM searches WHERE date BETWEEN '20240101' AND '20240130')""", "push_customers searches")
def _(t):
    return audience.without_search(t.searches(), t.push_customers(), _MONTH, "lonely")


def _hours_sql(seed: str, hours: tuple[int, ...], users: str) -> str:
    slots = ", ".join(f"({h})" for h in hours)
    return f"""SELECT user_id, hour FROM (SELECT user_id, least(click_days_month, 6) AS n, h AS hour,
        row_number() OVER (PARTITION BY user_id ORDER BY {draw(seed, 'user_id', 'h')}, h) AS r FROM push_users, (VALUES {slots}) v(h) WHERE {users}) WHERE r <= n"""


@query("audience_n_hours", _hours_sql("v8", audience.SEARCHER_HOURS, "clicks_month >= 1 AND click_days_month >= 1 AND user_id IN (SELECT user_id FROM month_searchers)"),
       "push_users month_searchers")
def _(t):
    return audience.searchers_n_hours(t.searches(), t.push_users(), _MONTH, "v8")


@query("audience_n_hours_all", _hours_sql("all", audience.EVERYONE_HOURS, "clicks_month >= 1 AND click_days_month >= 1"), "push_users")
def _(t):
    return audience.everyone_n_hours(t.push_users(), "all")


@query("audience_n_hours_lapsed", _hours_sql("lapsed", audience.LAPSED_HOURS, "clicks_month >= 3 AND clicks_week <= 1 AND user_id IN (SELECT user_id FROM month_searchers)"),
       "push_users month_searchers")
def _(t):
    return audience.lapsed_n_hours(t.searches(), t.push_users(), _MONTH, "lapsed")


@query("audience_no_search", """SELECT user_id FROM (SELECT DISTINCT user_id FROM push_customers WHERE click_days_week > 1 AND clicks_week > 1)
    WHERE user_id NOT IN (SELECT user_id FROM searches WHERE date BETWEEN '20240101' AND '20240130') UNION ALL SELECT user_id FROM allow_users""",
       "push_customers searches allow_users")
def _(t):
    return audience.no_search(t.searches(), t.push_customers(), _MONTH, t.allow_users())


@query("split_audience", f"""SELECT CAST(floor({u01('split', 'user_id')} * 4) + 1 AS INTEGER) AS part, user_id FROM push_users
    UNION SELECT CAST(p AS INTEGER), user_id FROM allow_users, (VALUES (1), (2), (3), (4)) v(p)""", "push_users allow_users")
def _(t):
    return audience.split_audience(t.push_users().select("user_id"), t.allow_users(), 4, "split")


@query("hot_query_project", """SELECT CAST(o_orderkey AS VARCHAR) AS org_id, o_orderpriority AS org_name, 'orders' AS org_source, '' AS org_image_url,
    CAST(o_custkey AS VARCHAR) AS org_abstract, o_orderstatus AS org_type, o_orderpriority AS org_category, CAST(o_custkey % 50 AS VARCHAR) AS org_position,
    CASE o_orderstatus WHEN 'F' THEN '1' ELSE '0' END AS org_status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.0' AS org_create_time,
    strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') || '.0' AS org_update_time, o_orderstatus AS org_show_title,
    substr('bs_' || o_orderkey, 1, 17) AS id, '全网热搜' AS title, o_orderpriority AS subtitle, '' AS url, strftime(o_orderdate, '%Y%m%d') AS create_time_date,
    strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d') AS update_time_date, 'browser' AS availability FROM orders""")
def _(t):
    status, made = F.col("o_orderstatus"), F.col("o_orderdate")
    return hot.project_hot_queries(t.table("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.lit("orders").alias("source"), F.lit("").alias("image_url"),
        F.col("o_custkey").alias("abstract"), status.alias("type"), F.col("o_orderpriority").alias("category"),
        (F.col("o_custkey") % 50).alias("position"), F.when(status == "F", 1).otherwise(0).alias("status"), made.alias("create_time"),
        (made + F.expr("INTERVAL 1 DAY")).alias("update_time"), status.alias("show_title")))
