"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nested import feature_columns, normalise_features, rename_features
from ..operators import filters as ops, reports
from ..operators.neighbours import export_vectors, knn, neighbour_text
from ..sources import logs
from .base import query, r6
from .inputs import AS_OF
from .sqltext import define

@query("locale_filter", """SELECT 'list' AS predicate, count(*) AS n FROM track WHERE locale IN ('NATION_3', 'NATION_4')
    UNION ALL SELECT 'cluster', count(*) FROM track WHERE cluster = 'ASIA'
    UNION ALL SELECT 'member', count(*) FROM track WHERE cluster = (SELECT cluster FROM regions WHERE locale = 'NATION_7')
    UNION ALL SELECT 'single', count(*) FROM track WHERE locale = 'NATION_1'""", "track")
def _(t):
    predicates = {"list": ("NATION_3,NATION_4", ()), "cluster": ("ASIA", ()), "member": ("NATION_7", True), "single": ("NATION_1", ())}
    rows = t.track().select("locale").join(ops.locale_flags(t.regions(), predicates), "locale")
    counts = rows.agg(*[F.count_if(name).alias(name) for name in predicates])
    return counts.unpivot([], list(predicates), "predicate", "n")


@query("locale_normalise", """SELECT event_id, CASE WHEN cluster = 'ASIA' THEN 'OTHER' ELSE locale END AS name,
    'catalog_' || lower(cluster) AS catalog FROM track""", "track")
def _(t):
    catalogs = t.regions().select("locale", F.concat(F.lit("catalog_"), F.lower("cluster")).alias("catalog"),
                                  (F.col("cluster") == "ASIA").alias("joint"))
    return (t.track().select("event_id", "locale").join(catalogs, "locale")
            .select("event_id", ops.locale_name("locale", F.col("joint")).alias("name"), "catalog"))


@query("valid_id_filter", """SELECT event_id, launch_ref FROM track WHERE launch_ref IS NOT NULL AND launch_ref <> ''""", "track")
def _(t):
    return t.track().where(ops.valid_id("launch_ref")).select("event_id", "launch_ref")


@query("allow_deny_filter", """SELECT event_id, item_id FROM track
    WHERE item_id IN (SELECT item_id FROM latest WHERE level IN ('S', 'A')) AND item_id NOT IN (SELECT item_id FROM denied)""",
       "track latest denied")
def _(t):
    allow = ops.catalog_by_level(t.latest_catalog(), ["S", "A"]).select("item_id")
    return ops.allow_deny(t.track(), "item_id", allow, t.denied_items()).select("event_id", "item_id")


def quality(t):
    """``item_id, retention, usage`` from the log: activations per install and mean daily value."""
    acts = t.track().groupBy("item_id").agg(
        F.count_if(F.col("action") == "activate").alias("a"), F.count_if(F.col("action") == "install").alias("i"),
        (F.sum("value") / 30).alias("usage"))
    return acts.select("item_id", F.coalesce(F.try_divide("a", "i"), F.lit(0.0)).alias("retention"), "usage")


define("quality", "track", """SELECT item_id, coalesce(a / nullif(i, 0), 0) AS retention, usage FROM (SELECT item_id,
    count(*) FILTER (action = 'activate') AS a, count(*) FILTER (action = 'install') AS i, sum(value) / 30 AS usage
    FROM track GROUP BY item_id)""")


@query("eligible_items", """WITH uninstall_rate AS (SELECT item_id, i, u / nullif(i, 0) AS hour_rate FROM (SELECT item_id,
        count(DISTINCT user_id) FILTER (action = 'install') AS i, count(DISTINCT user_id) FILTER (action = 'uninstall') AS u
        FROM track GROUP BY item_id))
    SELECT DISTINCT item_id FROM catalog
    WHERE ((date = '20240130' AND level IN ('C', 'D')) OR (date < '20240130' AND level IN ('S', 'A', 'B')))
    AND item_id IN (SELECT item_id FROM catalog WHERE gp_score >= 2) AND item_id IN (SELECT item_id FROM catalog WHERE display_score >= 2)
    AND item_id IN (SELECT item_id FROM quality WHERE retention >= 0.05 OR usage >= 1) AND item_id NOT IN (SELECT item_id FROM denied)
    AND item_id NOT IN (SELECT r.item_id FROM uninstall_rate r JOIN latest l ON r.item_id = l.item_id WHERE l.level IN ('C', 'D') AND hour_rate > 0.7)""",
       "catalog quality denied latest")
def _(t):
    rates = t.track().groupBy("item_id").agg(
        F.count_distinct(F.when(F.col("action") == "install", F.col("user_id"))).alias("i"),
        F.count_distinct(F.when(F.col("action") == "uninstall", F.col("user_id"))).alias("u"))
    uninstalls = rates.join(t.latest_catalog().select("item_id", "level"), "item_id").select(
        "item_id", "level", F.try_divide("u", "i").alias("hour_rate"))
    return ops.eligible_items(t.catalog(), AS_OF, ["S", "A", "B"], ["C", "D"], deny=[t.denied_items()],
                              quality=quality(t), uninstalls=uninstalls)


@query("audit_deny_list", "SELECT DISTINCT item_id FROM catalog WHERE date BETWEEN '20240124' AND '20240131' AND audit_tag IN (7, 13, 21)",
       "catalog")
def _(t):
    return ops.audit_deny_list(t.catalog().select("item_id", "audit_tag", "date"), [7, 13, 21], AS_OF)


def action_lists(t):
    """Hot lists by action: ``list_id, item, score`` with distinct users as score."""
    return t.track().groupBy(F.concat(F.lit("hot_"), "action").alias("list_id"), F.col("item_id").cast("string").alias("item")).agg(
        F.count_distinct("user_id").cast("double").alias("score"))


define("action_lists", "track", """SELECT 'hot_' || action AS list_id, CAST(item_id AS VARCHAR) AS item,
    CAST(count(DISTINCT user_id) AS DOUBLE) AS score FROM track GROUP BY 1, 2""")


@query("recall_deny_list", """SELECT DISTINCT item FROM action_lists WHERE list_id IN ('hot_item_click', 'hot_download_install')
    QUALIFY row_number() OVER (PARTITION BY list_id ORDER BY score DESC, item) <= 20""", "action_lists")
def _(t):
    return ops.hot_deny_list(action_lists(t), ["hot_item_click", "hot_download_install"], 20)


@query("latest_catalog", "SELECT item_id, level, category_id, tagids FROM latest WHERE level IN ('S', 'B')", "latest")
def _(t):
    return ops.catalog_by_level(t.latest_catalog(), ["S", "B"])


@query("item_tags_filtered", """WITH tags AS (SELECT DISTINCT item_id, CAST(unnest(from_json(tagids, '["VARCHAR"]')) AS INTEGER) AS tag FROM latest),
    e AS (SELECT item_id, date, count(DISTINCT user_id) AS e FROM track WHERE page = 'recommend' AND action = 'item_exposure' GROUP BY ALL),
    d AS (SELECT item_id, date, count(DISTINCT user_id) AS d FROM track WHERE action = 'download_install'
          AND install_status = 'download_request' AND install_type IN ('manual_install', 'auto_install') GROUP BY ALL),
    rates AS (SELECT item_id, sum(e) AS e, sum(d) AS d FROM e JOIN d USING (item_id, date) GROUP BY item_id)
    SELECT item_id, tag FROM tags WHERE tag IN (SELECT tag FROM tags GROUP BY tag HAVING count(*) >= 50)
    AND tag IN (SELECT tag FROM tags JOIN rates USING (item_id) GROUP BY tag HAVING sum(d) / sum(e) >= 0.95)""", "latest track")
def _(t):
    track = t.track()
    shown = track.where((F.col("page") == "recommend") & (F.col("action") == "item_exposure"))
    got = track.where((F.col("action") == "download_install") & (F.col("install_status") == "download_request")
                      & F.col("install_type").isin("manual_install", "auto_install"))
    return ops.item_tags_filtered(
        t.latest_catalog(), shown.groupBy("item_id", "date").agg(F.count_distinct("user_id").alias("exposure_uv")),
        got.groupBy("item_id", "date").agg(F.count_distinct("user_id").alias("download_puv")), min_items=50, min_rate=0.95)


@query("activity_band_filter", """WITH kept AS (SELECT * FROM ratings
        WHERE user_id IN (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) > 1 AND count(*) < 45))
    SELECT user_id, item_id, score FROM kept
    WHERE item_id IN (SELECT item_id FROM kept GROUP BY item_id HAVING count(*) > 1 AND count(*) < 30)""", "ratings")
def _(t):
    return ops.activity_band(t.ratings(), "user_id", "item_id", (1, 45), (1, 30))


@query("drop_heavy_users", """SELECT event_id, user_id, item_id FROM track
    WHERE user_id NOT IN (SELECT user_id FROM track GROUP BY user_id HAVING count(DISTINCT item_id) > 50)""", "track")
def _(t):
    return ops.drop_heavy(t.track(), "user_id", "item_id", 50).select("event_id", "user_id", "item_id")


@query("rename_features", """SELECT item_id, gp_score AS f_gp_score_x, display_score AS f_display_score_x, level FROM latest""", "latest")
def _(t):
    rows = t.latest_catalog().select("item_id", "gp_score", "display_score", "level")
    renamed = rename_features(rows, "f_", "_x", keep=("item_id", "level"))
    return renamed.select("item_id", *feature_columns(renamed, drop=("item_id",)))


@query("normalise_features", """SELECT id, CAST(CAST(label AS FLOAT) AS DOUBLE) AS label_1, 1 AS label_size, 64 AS vector_size,
    round(CAST(CAST(vector[1] AS FLOAT) AS DOUBLE), 6) AS vector_1, 'cluster' || label AS kind FROM vectors""", "vectors")
def _(t):
    rows = t.table("embeddings").select(
        F.col("vec_id").cast("string").alias("id"), "label", F.col("embedding").cast("array<double>").alias("vector"),
        F.concat(F.lit("cluster"), "label").alias("kind"), F.array().cast("array<double>").alias("nothing"))
    typed = normalise_features(rows, keep=("id",)).where(F.col("nothing").isNull())
    return typed.select("id", F.get("label", 0).cast("double").alias("label_1"), F.size("label").alias("label_size"),
                        F.size("vector").alias("vector_size"), r6(F.get("vector", 0).cast("double"), "vector_1"), "kind")


@query("parse_push_payload", "SELECT user_id, log_date, item_id, type, push_id, push_date, push_hour, push_minute, task_id FROM push_log", "push_log")
def _(t):
    return logs.push_events(t.push_log()).drop("reach_ms")


_BY = """SELECT push_id, {case} AS expid FROM push_log"""
_BY_MINUTE = ("CASE push_minute WHEN '00' THEN 'push_at_00min' WHEN '15' THEN 'push_at_15min' WHEN '30' THEN 'push_at_30min' "
              "WHEN '45' THEN 'push_at_45min' END")
_BY_TASK = ("CASE task_id WHEN 'SH' THEN 'no_score' WHEN 'BSOF' THEN 'position_score' "
            "WHEN 'BSPT' THEN 'position_and_updateTime_score' END")
_BY_BOTH = ("CASE WHEN task_id = 'BSOF' AND push_minute = '00' THEN 'exp_position_score' "
            "WHEN task_id = 'BSPT' THEN 'exp_new_score' END")


@query("expid_by_minute", _BY.format(case=_BY_MINUTE), "push_log")
def _(t):
    return reports.by_minute(logs.push_events(t.push_log())).select("push_id", "expid")


@query("expid_by_task", _BY.format(case=_BY_TASK), "push_log")
def _(t):
    return reports.by_task(logs.push_events(t.push_log())).select("push_id", "expid")


@query("expid_by_both", f"SELECT * FROM ({_BY.format(case=_BY_BOTH)}) WHERE expid IS NOT NULL", "push_log")
def _(t):
    return reports.by_task_and_minute(logs.push_events(t.push_log())).select("push_id", "expid")


@query("parse_experiment_ids", """SELECT event_id, exp_day AS exp_date, CAST(unnest([event_id % 4, event_id % 5]) AS VARCHAR) AS model_id
    FROM track WHERE packed IS NOT NULL""", "track")
def _(t):
    fields = logs.experiment_fields("packed")
    rows = t.track().select("event_id", fields["exp_date"].alias("exp_date"), fields["model_ids"].alias("ids"))
    return rows.select("event_id", "exp_date", F.explode("ids").alias("model_id"))


@query("sim_list_trim", """WITH pairs AS (SELECT a.id AS item, b.id AS near, round(list_cosine_similarity(a.vector, b.vector), 12) AS sim
        FROM vectors a JOIN vectors b ON a.id <> b.id),
    best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY item ORDER BY sim DESC, near) <= 20),
    kept AS (SELECT item, near, row_number() OVER (PARTITION BY item ORDER BY sim DESC, near) AS r FROM best
        WHERE round(sim, 6) > 0.2 AND near IN (SELECT id FROM vectors WHERE label < 8))
    SELECT v.id AS item, coalesce(s.similar, '') AS similar FROM vectors v LEFT JOIN
        (SELECT item, string_agg(near, ',' ORDER BY r) AS similar FROM kept WHERE r <= 5 GROUP BY item) s ON v.id = s.item""", "vectors")
def _(t):
    lists = neighbour_text(knn(t.vectors(), 20)).withColumnRenamed("id", "item")
    allowed = t.table("embeddings").where(F.col("label") < 8).select(F.col("vec_id").cast("string").alias("id"))
    return ops.trim_similar(lists, allowed, min_sim=0.2, n=5)


@query("export_vectors", """SELECT CAST(vec_id AS VARCHAR) AS id, len(embedding) AS size, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total
    FROM embeddings WHERE len(embedding) = 64""")
def _(t):
    rows = export_vectors(t.table("embeddings"), "vec_id", "embedding", 64)
    numbers = F.transform(F.split("value", " "), lambda x: x.cast("double"))
    return rows.select("id", F.size(numbers).cast("long").alias("size"),
                       F.round(F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x), 4).alias("total"))
