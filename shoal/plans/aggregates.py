"""Aggregations, funnels, reports and window results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hot, reports
from ..operators.cf import item_cf
from ..operators.topn import i2i_stats, i2i_top_n, rank_any_under, recall_counts
from ..sources import logs
from .base import joined, query, r6
from .inputs import NEW_SNAPSHOT
from .sqltext import define, u01, wilson_sql


@query("agg_basic", """SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_partkey) AS parts,
    round(sum(l_extendedprice), 2) AS price_sum, round(avg(l_quantity), 6) AS quantity_mean, min(l_discount) AS discount_min,
    max(l_tax) AS tax_max FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def _(t):
    return t.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.count_distinct("l_partkey").alias("parts"), F.round(F.sum("l_extendedprice"), 2).alias("price_sum"),
        r6(F.avg("l_quantity"), "quantity_mean"), F.min("l_discount").alias("discount_min"), F.max("l_tax").alias("tax_max"))


define("funnel", "track latest", """SELECT t.user_id, t.item_id, t.date, t.time_ms, t.action, t.page, t.pre_page, t.card_type,
    t.pre_card_type, t.install_status, t.install_type, l.level, u.uninstall_hour, u.uninstall_ms,
    CAST(unnest([event_id % 4, event_id % 5]) AS VARCHAR) AS model_id
    FROM track t JOIN latest l ON t.item_id = l.item_id LEFT JOIN (SELECT user_id, item_id, date, hour AS uninstall_hour,
        max(time_ms) AS uninstall_ms FROM track WHERE action = 'uninstall' GROUP BY ALL) u
    ON t.user_id = u.user_id AND t.item_id = u.item_id AND t.date = u.date
    WHERE t.packed IS NOT NULL AND t.exp_day = t.date""")

define("exposure_stats", "funnel", """SELECT date, model_id, level,
    count(*) FILTER (page = 'recommend' AND action = 'item_exposure') AS exposure_pv,
    count(DISTINCT user_id) FILTER (page = 'recommend' AND action = 'item_exposure') AS exposure_uv,
    count(DISTINCT item_id) FILTER (page = 'recommend' AND action = 'item_exposure') AS exposure_app,
    count(*) FILTER (page = 'recommend' AND action = 'item_click') AS click_pv,
    count(DISTINCT user_id) FILTER (page = 'recommend' AND action = 'item_click') AS click_uv,
    count(DISTINCT item_id) FILTER (page = 'recommend' AND action = 'item_click') AS click_app,
    count(*) FILTER (page = 'recommend' AND action = 'item_exposure') AS exposure_app_pv
    FROM funnel GROUP BY date, model_id, level""")

_KEPT = "(uninstall_hour IS NULL OR uninstall_ms - time_ms > 3600000)"
_STAGE = """SELECT date, model_id, level, count(*) AS {s}_pv, count(DISTINCT user_id) AS {s}_uv,
    count(DISTINCT (user_id, item_id)) AS {s}_puv, count(DISTINCT item_id) AS {s}_app,
    count(*) FILTER ({kept}) AS eff_{s}_pv, count(DISTINCT user_id) FILTER ({kept}) AS eff_{s}_uv,
    count(DISTINCT item_id) FILTER ({kept}) AS eff_{s}_app, count(*) FILTER ({kept}) AS eff_{s}_puv{more}
    FROM funnel WHERE ((page = 'recommend' AND card_type = 'recApps')
        OR (page LIKE '%detail%' AND pre_page = 'recommend' AND pre_card_type = 'recApps')) AND {cond}
    GROUP BY date, model_id, level"""
_UNINSTALLS = """, count(DISTINCT user_id) FILTER (uninstall_ms > time_ms) AS uninstall_uv,
    count(DISTINCT item_id) FILTER (uninstall_ms > time_ms) AS uninstall_app, count(*) FILTER (uninstall_ms > time_ms) AS uninstall_puv,
    count(*) FILTER (uninstall_ms > time_ms) AS uninstall_puv_day,
    count(*) FILTER (uninstall_ms > time_ms AND uninstall_ms - time_ms < 3600000) AS uninstall_puv_hour"""
_BY_USER = "action = 'download_install' AND install_status = '{}' AND install_type IN ('manual_install', 'auto_install')"
define("download_stats", "funnel", _STAGE.format(s="download", kept=_KEPT, more=_UNINSTALLS, cond=_BY_USER.format("download_request")))
define("install_stats", "funnel", _STAGE.format(s="install", kept=_KEPT, more="", cond=_BY_USER.format("install_success")))
define("active_stats", "funnel", _STAGE.format(s="active", kept=_KEPT, more="", cond="action = 'activate'"))


def _funnel(t):
    return reports.funnel_track(t.track(), t.latest_catalog())


for _name in ("exposure_stats", "download_stats", "install_stats", "active_stats"):
    query(_name, f"SELECT * FROM {_name}", _name)(lambda t, stage=getattr(reports, _name): stage(_funnel(t)))

_REPORT = """SELECT {dims}, round(avg(exposure_app_pv), 6) AS exposure_app_pv, round(avg(download_puv), 6) AS download_puv,
    round(avg(install_puv), 6) AS install_puv, round(avg(uninstall_puv_day), 6) AS uninstall_puv_day,
    round(avg(uninstall_puv_hour), 6) AS uninstall_puv_hour, round(avg(uninstall_puv_day) / avg(install_puv), 4) AS uninstall_day_rate,
    round(avg(uninstall_puv_hour) / avg(install_puv), 4) AS uninstall_hour_rate
    FROM exposure_stats JOIN download_stats USING (date, model_id, level) JOIN install_stats USING (date, model_id, level)
    JOIN active_stats USING (date, model_id, level) GROUP BY {dims}"""
_MEANS = ["exposure_app_pv", "download_puv", "install_puv", "uninstall_puv_day", "uninstall_puv_hour"]


def _report(t, by_model):
    rows = reports.funnel_report(_funnel(t), by_model)
    return rows.withColumns({m: F.round(m, 6) for m in _MEANS})


@query("funnel_report_model", _REPORT.format(dims="date, model_id, level"), "exposure_stats download_stats install_stats active_stats")
def _(t):
    return _report(t, True)


@query("funnel_report", _REPORT.format(dims="date, level"), "exposure_stats download_stats install_stats active_stats")
def _(t):
    return _report(t, False)


_LEVELS = ["S", "A", "B", "C", "D"]


@query("uninstall_rate", """WITH i AS (SELECT DISTINCT user_id, item_id, date, time_ms FROM track WHERE action IN ('install', 'download_install')),
    u AS (SELECT DISTINCT user_id, item_id, date, time_ms FROM track WHERE action = 'uninstall'),
    daily AS (SELECT i.item_id, i.date, count(DISTINCT i.user_id) AS n,
        count(DISTINCT i.user_id) FILTER (u.time_ms > i.time_ms AND u.time_ms - i.time_ms <= 3600000) AS h,
        count(DISTINCT i.user_id) FILTER (u.time_ms > i.time_ms AND u.time_ms - i.time_ms <= 86400000) AS d
        FROM i LEFT JOIN u ON i.user_id = u.user_id AND i.item_id = u.item_id AND i.date = u.date GROUP BY ALL)
    SELECT d.item_id, l.level, sum(n)::BIGINT AS install_uv, sum(h)::BIGINT AS hour_uninstall_uv, sum(d.d)::BIGINT AS day_uninstall_uv,
        round(sum(h) / sum(n), 4) AS hour_uninstall_rate, round(sum(d.d) / sum(n), 4) AS day_uninstall_rate
    FROM daily d JOIN latest l ON d.item_id = l.item_id WHERE h > 0 OR d.d > 0 GROUP BY d.item_id, l.level""", "track latest")
def _(t):
    track = t.track()
    return reports.uninstall_rate(track.where(F.col("action").isin("install", "download_install")),
                                  track.where(F.col("action") == "uninstall"), t.latest_catalog(), _LEVELS)


_AB = """SELECT push_date, task_id, push_minute, user_id, type, CASE task_id WHEN 'SH' THEN 'no_score' WHEN 'BSOF' THEN 'position_score'
    WHEN 'BSPT' THEN 'position_and_updateTime_score' END AS expid FROM push_log"""
define("ab", "push_log", f"""SELECT push_date, expid, count(*) FILTER (type = 'EXPOSE') AS pv_expose, count(*) FILTER (type = 'CLICK') AS pv_click,
    count(DISTINCT user_id) FILTER (type = 'EXPOSE') AS uv_expose, count(DISTINCT user_id) FILTER (type = 'CLICK') AS uv_click
    FROM ({_AB}) GROUP BY push_date, expid""")


def _ab(t):
    return reports.ab_stats(reports.by_task(logs.push_events(t.push_log())))


@query("ab_ctr", """SELECT push_date, expid, pv_expose, pv_click, round(pv_click / pv_expose, 6) AS pv_ctr, uv_expose, uv_click,
    round(uv_click / uv_expose, 6) AS uv_ctr FROM ab""", "ab")
def _(t):
    return _ab(t).withColumns({c: F.round(c, 6) for c in ("pv_ctr", "uv_ctr")})


@query("metrics_long", """SELECT push_date, expid, unnest(['pv_expose', 'pv_click', 'pv_ctr', 'uv_expose', 'uv_click', 'uv_ctr']) AS index_key,
    round(unnest([CAST(pv_expose AS DOUBLE), pv_click, pv_click / pv_expose, uv_expose, uv_click, uv_click / uv_expose]), 6) AS index_value FROM ab""",
       "ab")
def _(t):
    rows = reports.long_metrics(_ab(t), ["push_date", "expid"], ["pv_expose", "pv_click", "pv_ctr", "uv_expose", "uv_click", "uv_ctr"])
    return rows.withColumn("index_value", F.round("index_value", 6))


# Daily statistics per locale, arm and page, the shape of the wide report table: kinds of events as (Spark, SQL).
_WIDE_DIMS = ["date", "locale", "model_id", "page", "stat_type"]
_KINDS = {"expose": "action = 'item_exposure'", "click": "action = 'item_click'", "download": "action = 'download_install'",
          "install": "action = 'install'", "active": "action = 'activate'", "get": "action = 'download_install' AND install_type = 'auto_install'",
          "detail_expose": "action = 'item_exposure' AND pre_page = 'recommend'",
          "detail_download": "action = 'download_install' AND pre_card_type = 'recApps'", "gone": "action = 'uninstall'",
          "kept": "action = 'install' AND card_pos < 5", "searched": "action = 'item_click' AND card_type = 'recApps'",
          "back": "action = 'item_click' AND card_type = 'recApps' AND hour >= 12"}
_MEANS_OF = {"down_scroll_rate": "CASE WHEN card_pos >= 3 THEN 1.0D ELSE 0.0D END", "slide_rate": "CASE WHEN card_pos = 5 THEN 1.0D ELSE 0.0D END",
             "retain_rate": "CASE WHEN hour >= 12 THEN 1.0D ELSE 0.0D END"}
# Columns of the wide table by the counts above.
_WIDE = {"expose_pv": "expose_pv", "expose_uv": "expose_uv", "click_pv": "click_pv", "click_uv": "click_uv", "download_num": "download_pv",
         "download_uv": "download_uv", "download_puv": "download_puv", "install_num": "install_pv", "install_uv": "install_uv",
         "install_puv": "install_puv", "active_num": "active_pv", "active_uv": "active_uv", "active_puv": "active_puv",
         "discover_get_pv": "get_pv", "discover_get_uv": "get_uv", "discover_get_puv": "get_puv", "discover_detail_expose_uv": "detail_expose_uv",
         "discover_detail_expose_pv": "detail_expose_pv", "discover_detail_download_uv": "detail_download_uv",
         "discover_detail_download_pv": "detail_download_pv", "discover_detail_download_puv": "detail_download_puv",
         "uninstall_puv2": "gone_puv", "eff_install_puv": "kept_puv", "search_uv": "searched_uv", "search_retain_uv": "back_uv"}
_OF_KIND = {"pv": "count(*) FILTER ({c})", "uv": "count(DISTINCT user_id) FILTER ({c})", "puv": "count(DISTINCT (user_id, item_id)) FILTER ({c})"}


def _counted(name: str) -> str:
    kind, _, what = name.rpartition("_")
    return _OF_KIND[what].format(c=_KINDS[kind])


define("wide", "track", f"""SELECT date, locale, CAST(event_id % 4 AS VARCHAR) AS model_id, page, launch_pkg AS stat_type,
    {', '.join(f'{_counted(source)} AS {name}' for name, source in _WIDE.items())},
    {', '.join(f"avg({sql.replace('D ', ' ')}) AS {name}" for name, sql in _MEANS_OF.items())} FROM track GROUP BY ALL""")


def _wide(t):
    track = t.track().withColumn("model_id", (F.col("event_id") % 4).cast("string")).withColumn("stat_type", F.col("launch_pkg"))
    counted = reports.daily_counts(track, _WIDE_DIMS, {k: F.expr(c) for k, c in _KINDS.items()}, {m: F.expr(c) for m, c in _MEANS_OF.items()})
    return counted.select(*_WIDE_DIMS, *[F.col(source).alias(name) for name, source in _WIDE.items()], *_MEANS_OF)


_SUMS = ", ".join([f"sum({c})::BIGINT AS {c}" for c in _WIDE] + [f"sum({c}) AS {c}" for c in _MEANS_OF])
_ALL = ", ".join([*_WIDE, *_MEANS_OF])
define("arms", "wide", f"""SELECT {', '.join(_WIDE_DIMS)}, {_ALL}, false AS rolled FROM wide
    UNION ALL SELECT date, locale, '1_3' AS model_id, page, stat_type, {_SUMS}, true FROM wide
    WHERE model_id IN ('1', '3') GROUP BY date, locale, page, stat_type
    UNION ALL SELECT date, locale, '0_1_2' AS model_id, page, stat_type, {_SUMS}, true FROM wide
    WHERE model_id IN ('0', '1', '2') GROUP BY date, locale, page, stat_type""")
define("rolled", "arms regions", f"""SELECT * FROM arms UNION ALL SELECT date, 'ASIA' AS locale, model_id, page, stat_type, {_SUMS}, true FROM arms
    WHERE locale IN (SELECT locale FROM regions WHERE cluster = 'ASIA') GROUP BY date, model_id, page, stat_type""")
_ARM_GROUPS = {"1_3": ["1", "3"], "0_1_2": ["0", "1", "2"]}


def _rolled(t, *columns: str):
    """Rolled up over the columns named: experiment groups, regions, or both at once."""
    wide, labels = _wide(t), {}
    if "locale" in columns:
        asia = t.regions().where(F.col("cluster") == "ASIA").select("locale", F.array(F.lit("ASIA")).alias("_regions"))
        wide, labels["locale"] = wide.join(asia, "locale", "left"), F.col("_regions")
    if "model_id" in columns:
        labels["model_id"] = reports.labels_of(_ARM_GROUPS, "model_id")
    return reports.roll_up(wide, labels, _WIDE_DIMS, dropped=("_regions",))


_ROUNDED = ", ".join([*_WIDE, *[f"round({m}, 6) AS {m}" for m in _MEANS_OF]])


@query("arm_rollup", f"SELECT {', '.join(_WIDE_DIMS)}, rolled, {_ROUNDED} FROM arms", "arms")
def _(t):
    return _rolled(t, "model_id").withColumns({m: F.round(m, 6) for m in _MEANS_OF})


@query("region_rollup", f"SELECT {', '.join(_WIDE_DIMS)}, rolled, {_ROUNDED} FROM rolled", "rolled")
def _(t):
    return _rolled(t, "model_id", "locale").withColumns({m: F.round(m, 6) for m in _MEANS_OF})


def _report_sql(whole_market: bool) -> str:
    values = {n: f"CAST({a} AS DOUBLE) / nullif({b}, 0)" for n, a, b in reports.RATIOS} | {n: source for n, source in reports.COUNTS}
    values |= {n: f"CASE WHEN rolled THEN -1 ELSE {n} END" for n in reports.NOT_ADDITIVE}
    if whole_market:
        values |= {"search_retain_rate": "-1", "search_uv": "search_uv", "search_retain_uv": "search_retain_uv"}
    values |= {"uninstall_rate": "-1", "eff_install_puv": "eff_install_puv", "adpdau": "-1", "uninstall_puv2": "uninstall_puv2"}
    group = "CASE stat_type WHEN 'home' THEN 'Top1001_2000' WHEN 'ads' THEN '5000' ELSE stat_type END" + (" || '_all'" if whole_market else "")
    return f"""SELECT DISTINCT date, locale || '_' || model_id AS tag, page || '_' || stat_type || '_' || k AS index_key, round(v, 6) AS index_value FROM
        (SELECT date, locale, model_id, page, {group} AS stat_type, unnest({list(values)!r}) AS k,
            unnest([{', '.join(f'CAST({v} AS DOUBLE)' for v in values.values())}]) AS v FROM rolled) WHERE v IS NOT NULL"""


def _ranged(t):
    """Two of the groups stand for ranges of ranks, whose names the report writes another way."""
    kind = F.col("stat_type")
    return _rolled(t, "model_id", "locale").withColumn(
        "stat_type", F.when(kind == "home", "top1001-2000").when(kind == "ads", "5000+").otherwise(kind))


for _name, _market in (("report_ratios", False), ("report_whole_market", True)):
    query(_name, _report_sql(_market), "rolled")(
        lambda t, market=_market: reports.report_rows(_ranged(t), market).withColumn("index_value", F.round("index_value", 6)))


@query("user_item_sets", """SELECT user_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT user_id, CAST(item_id AS VARCHAR) AS item FROM track WHERE action = 'item_click') GROUP BY user_id""", "track")
def _(t):
    sets = hot.item_sets(t.track().where(F.col("action") == "item_click"), "user_id", "item_id")
    return sets.select("user_id", F.size("items").cast("long").alias("n"), joined("items", "items"))


@query("passive_action_set", """SELECT user_id, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT user_id, CAST(item_id AS VARCHAR) AS item
    FROM track WHERE first_page = 'minicard' AND ((launch_pkg IN ('ads', 'cleaner', 'browser') AND launch_ref LIKE 'DELIVERY%')
    OR (launch_pkg = 'home' AND launch_ref = 'push') OR launch_pkg IN ('ads', 'cleaner'))) GROUP BY user_id""", "track")
def _(t):
    sets = hot.passive_items(t.track(), pages=["minicard"], packages=["ads", "cleaner", "browser"], delivery="DELIVERY",
                             home="home", home_refs=["push"], chooser=["ads", "cleaner"])
    return sets.select("user_id", joined("items", "items"))


@query("user_search_actions", """SELECT user_id, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) FILTER (action = 'download_install') AS downloads,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) FILTER (action = 'item_click') AS clicks
    FROM track WHERE page = 'search' AND action IN ('download_install', 'item_click') GROUP BY user_id""", "track")
def _(t):
    sets = hot.sets_by_action(t.track().where(F.col("page") == "search"), "user_id", "item_id",
                              {"downloads": ["download_install"], "clicks": ["item_click"]})
    text = lambda c: F.when(F.size(c) > 0, joined(c, c)).alias(c)
    return sets.select("user_id", text("downloads"), text("clicks"))


@query("exposure_thresholds", """WITH c AS (SELECT user_id, item_id, count(*) AS n FROM track WHERE action = 'item_exposure' GROUP BY ALL)
    SELECT user_id, k AS threshold, CAST(item_id AS VARCHAR) AS item FROM c, (VALUES (1), (2), (6), (8)) v(k) WHERE n >= k""", "track")
def _(t):
    maps = hot.exposure_thresholds(t.track().where(F.col("action") == "item_exposure"), "user_id", "item_id")
    listed = F.array(*[F.struct(F.lit(k).alias("threshold"), F.map_keys(f"seen_{k}").alias("items")) for k in hot.THRESHOLDS])
    return (maps.select("user_id", F.explode(listed).alias("l")).select("user_id", "l.threshold", F.explode("l.items").alias("item")))


@query("group_concat_levels", """SELECT displayname, string_agg(DISTINCT locale || ':' || level, ',' ORDER BY locale || ':' || level) AS levels
    FROM latest GROUP BY displayname""", "latest")
def _(t):
    return hot.group_concat(t.latest_catalog(), "displayname", F.concat_ws(":", "locale", "level"), "levels")


@query("volume_check", """SELECT (SELECT count(DISTINCT item_id) FROM track WHERE date = '20240130') AS today,
    round((SELECT sum(n) FROM (SELECT count(DISTINCT item_id) AS n FROM track WHERE date BETWEEN '20231231' AND '20240129' GROUP BY date)) / 30, 6) AS mean_before,
    true AS ok""", "track")
def _(t):
    check = reports.volume_check(t.track().select("item_id", "date"), NEW_SNAPSHOT)
    return reports.require_volume(check).withColumn("mean_before", F.round("mean_before", 6))


define("itemcf", "ratings", """SELECT a.item_id AS item_1, b.item_id AS item_2,
    sum(a.score * b.score) / any_value(na.norm) / any_value(nb.norm) AS sim
    FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id < b.item_id
    JOIN (SELECT item_id, sqrt(sum(score * score)) AS norm FROM ratings GROUP BY item_id) na ON a.item_id = na.item_id
    JOIN (SELECT item_id, sqrt(sum(score * score)) AS norm FROM ratings GROUP BY item_id) nb ON b.item_id = nb.item_id
    GROUP BY a.item_id, b.item_id""")
define("i2i", "itemcf", """SELECT id, item, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, item) AS rank FROM (
    SELECT item_1 AS id, item_2 AS item, round(sim, 12) AS score FROM itemcf UNION ALL SELECT item_2, item_1, round(sim, 12) FROM itemcf)
    QUALIFY rank <= 20""")


def i2i_lists(t, n=20):
    """itemCF lists; similarities are compared to twelve places, so that ties go by item on every engine."""
    return i2i_top_n(item_cf(t.ratings(), best=n).withColumn("sim", F.round("sim", 12)), n, directed=True)


@query("i2i_stats", """SELECT count(*) AS items, max(n) AS max_neighbours, min(n) AS min_neighbours, round(max(hi), 6) AS max_score,
    round(min(lo), 6) AS min_score FROM (SELECT id, count(*) AS n, max(score) AS hi, min(score) AS lo FROM i2i GROUP BY id)""", "i2i")
def _(t):
    return i2i_stats(i2i_lists(t)).withColumns({c: F.round(c, 6) for c in ("max_score", "min_score")})


@query("i2i_coverage", """WITH c AS (SELECT item, count(*) AS times FROM i2i GROUP BY item)
    (SELECT 'most' AS side, item, times FROM c ORDER BY times DESC, item LIMIT 5)
    UNION ALL (SELECT 'least', item, times FROM c ORDER BY times, item LIMIT 5)""", "i2i")
def _(t):
    return recall_counts(i2i_lists(t), 5)


# Keyword statistics: how many users saw, clicked, downloaded and installed an item per keyword.
define("keyword_stats", "track", """SELECT keyword AS user_id, CAST(item_id AS VARCHAR) AS item_id, sum(e)::BIGINT AS exposure_uv, sum(c)::BIGINT AS click_uv,
    sum(d)::BIGINT AS download_uv, sum(i)::BIGINT AS install_uv FROM (SELECT keyword, item_id, date,
    count(DISTINCT user_id) AS e, count(DISTINCT user_id) FILTER (action = 'item_click') AS c,
    count(DISTINCT user_id) FILTER (action = 'download_install') AS d, count(DISTINCT user_id) FILTER (action = 'install') AS i
    FROM track GROUP BY keyword, item_id, date) GROUP BY keyword, item_id""")


def keyword_log(t):
    """``keyword, item_id, date`` with users per action; who acted on an item has seen it."""
    is_ = lambda a: F.count_distinct(F.when(F.col("action") == a, F.col("user_id")))
    return t.track().groupBy("keyword", "item_id", "date").agg(
        F.count_distinct("user_id").alias("exposure_uv"), is_("item_click").alias("click_uv"),
        is_("download_install").alias("download_uv"), is_("install").alias("install_uv"))


_IN_BAND = """(SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1 AND count(*) < {high})"""


@query("query_item_score_wilson", f"""SELECT * FROM (SELECT user_id, item_id, round({wilson_sql('download_uv', 'exposure_uv')}, 6) AS score
    FROM keyword_stats) WHERE score <> 0""", "keyword_stats")
def _(t):
    return hot.keyword_scores(keyword_log(t), "wilson").withColumn("score", F.round("score", 6)).where(F.col("score") != 0)


define("keyword_v2", "keyword_stats", f"""SELECT user_id, item_id, CAST(download_uv * 100 AS DOUBLE) AS score FROM keyword_stats
    WHERE user_id IN {_IN_BAND.format(k='user_id', t='keyword_stats', high=500)}""")


@query("query_item_score_v2", f"""SELECT user_id, item_id, score FROM keyword_v2 WHERE score > 0
    AND item_id IN {_IN_BAND.format(k='item_id', t='keyword_v2', high=10000)}""", "keyword_v2")
def _(t):
    return hot.keyword_scores(keyword_log(t), "downloads", times=100, users=(1, 500), items=(1, 10_000))


define("keyword_v9", "keyword_stats", """SELECT user_id, item_id, score FROM (SELECT user_id, item_id,
    10 * (10 * {c} + 50 * {d} + 100 * {i}) AS score FROM keyword_stats) WHERE score > 0""".format(
    **{k: wilson_sql(n, "exposure_uv") for k, n in (("c", "click_uv"), ("d", "download_uv"), ("i", "install_uv"))}))


@query("query_item_score_v9", f"""SELECT user_id, item_id, round(score, 6) AS score FROM keyword_v9
    WHERE user_id IN {_IN_BAND.format(k='user_id', t='keyword_v9', high=500)} AND item_id IN {_IN_BAND.format(k='item_id', t='keyword_v9', high=10000)}""",
       "keyword_v9")
def _(t):
    return hot.keyword_scores(keyword_log(t), "weighted", times=10, users=(1, 500), items=(1, 10_000)).withColumn("score", F.round("score", 6))


define("keyword_raw", "keyword_stats", "SELECT user_id, item_id, CAST(download_uv AS DOUBLE) AS score FROM keyword_stats")


@query("query_item_score_v6", f"""SELECT user_id, item_id, sum(score) AS score FROM (
    SELECT * FROM keyword_raw WHERE user_id IN {_IN_BAND.format(k='user_id', t='keyword_raw', high=500)}
        AND item_id IN {_IN_BAND.format(k='item_id', t='keyword_raw', high=40)}
    UNION ALL SELECT * FROM keyword_raw WHERE item_id IN (SELECT item_id FROM keyword_raw GROUP BY item_id HAVING count(*) > 40)
        AND {u01('keyword-sample', 'user_id', 'item_id')} < 0.05) GROUP BY user_id, item_id HAVING sum(score) > 0""", "keyword_raw")
def _(t):
    return hot.keyword_scores_sampled(keyword_log(t), crowded=40, fraction=0.05, users=(1, 500), seed="keyword-sample")


define("behaviour", "track", """SELECT DISTINCT user_id, item_id, action, date FROM track WHERE action IN ('activate', 'install', 'download_install')""")
define("behaviour_kept", "behaviour", """SELECT * FROM (SELECT * FROM behaviour WHERE user_id IN (SELECT user_id FROM behaviour GROUP BY user_id
    HAVING count(DISTINCT item_id) > 1 AND count(DISTINCT item_id) < 50)) x WHERE item_id IN (SELECT item_id FROM (SELECT * FROM behaviour WHERE user_id IN
    (SELECT user_id FROM behaviour GROUP BY user_id HAVING count(DISTINCT item_id) > 1 AND count(DISTINCT item_id) < 50))
    GROUP BY item_id HAVING count(DISTINCT user_id) > 1 AND count(DISTINCT user_id) < 10000)""")


@query("behaviour_score", """SELECT user_id, CAST(item_id AS VARCHAR) AS item_id, CAST(sum(CASE action WHEN 'download_install' THEN 2 ELSE 3 END) AS DOUBLE) AS score
    FROM behaviour_kept GROUP BY user_id, item_id""", "behaviour_kept")
def _(t):
    return hot.behaviour_scores(t.track(), hot.ACTION_WEIGHTS, users=(1, 50), items=(1, 10_000))


@query("behaviour_score_active", """WITH band AS (SELECT * FROM behaviour WHERE user_id IN (SELECT user_id FROM behaviour GROUP BY user_id
        HAVING count(DISTINCT item_id) > 1 AND count(DISTINCT item_id) < 100) AND item_id IN (SELECT item_id FROM behaviour GROUP BY item_id
        HAVING count(DISTINCT user_id) > 1 AND count(DISTINCT user_id) < 10000)),
    flags AS (SELECT user_id, max(CASE WHEN launch_ref = 'home' THEN 1 ELSE 0 END) AS active FROM track
        WHERE date = '20240130' AND ((launch_ref IS NOT NULL AND launch_ref <> '' AND launch_ref <> 'update') OR page_ref = 'miniCard') GROUP BY user_id)
    SELECT b.user_id, CAST(item_id AS VARCHAR) AS item_id, CAST(sum(CASE action WHEN 'download_install' THEN 2 ELSE 3 END * CASE active WHEN 1 THEN 4 ELSE 1 END) AS DOUBLE) AS score
    FROM band b JOIN flags f ON b.user_id = f.user_id GROUP BY b.user_id, item_id""", "behaviour track")
def _(t):
    from ..operators.profiles import active_flags

    flags = active_flags(t.track().where(F.col("date") == NEW_SNAPSHOT), home="home", ignored=["update"], page_refs=["miniCard"])
    return hot.behaviour_scores_active(t.track(), flags, hot.ACTION_WEIGHTS, users=(1, 100), items=(1, 10_000))


@query("item_downloads", """SELECT item_id, count(DISTINCT user_id) AS downloads FROM track WHERE action = 'activate' AND cluster = 'ASIA'
    AND date BETWEEN '20240101' AND '20240120' AND item_id NOT IN (SELECT item_id FROM denied) GROUP BY item_id""", "track denied")
def _(t):
    track = t.track().where((F.col("cluster") == "ASIA") & F.col("date").between("20240101", "20240120"))
    return hot.item_users(track, "activate", "downloads", deny=t.denied_items())


@query("rank_any_under_k", """SELECT p_partkey, round(a, 6) AS position_score, round(b, 6) AS update_score, round(c, 6) AS ctr_score FROM (
    SELECT p_partkey, p_retailprice AS a, CAST(p_size AS DOUBLE) AS b, q AS c, rank() OVER (ORDER BY p_retailprice DESC) AS ra,
    rank() OVER (ORDER BY p_size DESC) AS rb, rank() OVER (ORDER BY q DESC) AS rc
    FROM part JOIN (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_partkey) ON p_partkey = l_partkey)
    WHERE ra < 30 OR rb < 30 OR rc < 30""")
def _(t):
    sold = t.table("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("ctr_score"))
    scored = t.table("part").join(sold, "p_partkey").select(
        "p_partkey", F.col("p_retailprice").alias("position_score"), F.col("p_size").cast("double").alias("update_score"), "ctr_score")
    scores = ["position_score", "update_score", "ctr_score"]
    return rank_any_under(scored, scores, 30, "p_partkey").withColumns({s: F.round(s, 6) for s in scores})


@query("cumulative_pv_uv", """WITH h AS (SELECT DISTINCT user_id, CAST((time_ms // 3600000) % 24 AS INTEGER) AS hour, date FROM searches)
    SELECT x.hour, (SELECT count(*) FROM h WHERE h.hour <= x.hour AND h.hour >= 8) AS pv,
    (SELECT count(DISTINCT user_id) FROM h WHERE h.hour <= x.hour AND h.hour >= 8) AS uv FROM (SELECT DISTINCT hour FROM h WHERE hour BETWEEN 8 AND 22) x""",
       "searches")
def _(t):
    from ..functions.dates import hour_of
    from ..operators.audience import running_counts

    rows = t.searches().select("user_id", hour_of("time_ms").alias("hour"), "date").distinct()
    return running_counts(rows, 8, 22)
