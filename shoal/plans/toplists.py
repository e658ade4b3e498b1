"""Hot, trending, cold-start, fallback and favourite lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import day_shift
from ..operators import filters, hot
from ..operators.filters import FIRST_GAME
from ..operators.neighbours import knn
from ..sources import logs
from .aggregates import i2i_lists
from .base import query, r6
from .inputs import AS_OF, NEW_SNAPSHOT
from .sqltext import define, wilson_sql


@query("i2i_topn", "SELECT id, item, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM i2i", "i2i")
def _(t):
    return i2i_lists(t).withColumn("score", F.round("score", 6))


def _pool(t):
    """Recommendable items of the newest catalog: all but level D."""
    return filters.catalog_by_level(t.latest_catalog(), ["S", "A", "B", "C"]).select("item_id")


define("pool", "latest", "SELECT item_id FROM latest WHERE level <> 'D'")
_CUT = "QUALIFY row_number() OVER (PARTITION BY list_id ORDER BY score DESC, item) <= {}"


@query("hot_in_rec", f"""WITH s AS (SELECT d.item_id, l.category_id, CAST(count(*) AS DOUBLE) AS score FROM
        (SELECT DISTINCT user_id, item_id, date FROM track WHERE action = 'download_install') d JOIN latest l ON d.item_id = l.item_id
        WHERE d.item_id IN (SELECT item_id FROM pool) GROUP BY d.item_id, l.category_id)
    SELECT CASE WHEN category_id >= 100 THEN 'hot_games_v1' ELSE 'hot_apps_v1' END AS list_id, CAST(item_id AS VARCHAR) AS item, score
        FROM s WHERE category_id > 0 {_CUT.format(20)}
    UNION ALL (SELECT 'hot_categories_v1', CAST(category_id AS VARCHAR), sum(score) FROM s GROUP BY category_id
        ORDER BY 3 DESC, 2 LIMIT 13)""", "track latest pool")
def _(t):
    return hot.hot_in_rec(t.track(), t.latest_catalog(), _pool(t), 20, "_v1")


@query("hot_in_search", f"""WITH c AS (SELECT CASE action WHEN 'item_exposure' THEN 'top_exposed' WHEN 'download_install' THEN 'top_downloaded'
        ELSE 'top_clicked' END AS list_id, CAST(item_id AS VARCHAR) AS item, CAST(count(*) AS DOUBLE) AS score FROM
        (SELECT DISTINCT user_id, keyword, item_id, action, date FROM track WHERE page = 'search'
            AND action IN ('item_exposure', 'download_install', 'item_click') AND item_id IN (SELECT item_id FROM pool)) GROUP BY 1, 2),
    top AS (SELECT * FROM c {_CUT.format(15)})
    SELECT * FROM top UNION ALL SELECT DISTINCT 'top_items', item, 1.0::DOUBLE FROM top WHERE list_id IN ('top_exposed', 'top_downloaded')""",
       "track pool")
def _(t):
    return hot.hot_in_search(t.track().where(F.col("page") == "search"), _pool(t), 15)


@query("supplement_lists", f"""WITH s AS (SELECT item_id, count(*) AS n FROM track WHERE action = 'activate' GROUP BY item_id),
    base AS (SELECT l.*, CAST(coalesce(n, 0) AS DOUBLE) AS score FROM latest l LEFT JOIN s ON l.item_id = s.item_id WHERE level <> 'D'),
    rows AS (SELECT 'supplement_' || locale AS list_id, item_id, score FROM base
        UNION ALL SELECT 'supplement_' || locale || '_category_' || category_id, item_id, score FROM base
        UNION ALL SELECT 'supplement_' || locale || CASE WHEN category_id >= 100 THEN '_game' ELSE '_app' END, item_id, score FROM base
        UNION ALL SELECT 'supplement_' || locale || '_dev', item_id, score FROM base WHERE developer_id > 0
        UNION ALL SELECT DISTINCT 'supplement_' || locale || '_tag_' || tag, item_id, score
            FROM (SELECT *, unnest(from_json(tagids, '["VARCHAR"]')) AS tag FROM base))
    SELECT list_id, CAST(item_id AS VARCHAR) AS item, score FROM rows {_CUT.format(1000)}""", "track latest")
def _(t):
    scores = t.track().where(F.col("action") == "activate").groupBy("item_id").agg(F.count("*").alias("score"))
    return hot.supplement_lists(t.latest_catalog(), scores, ["S", "A", "B", "C"])


def _classes(t):
    return t.latest_catalog().select("item_id", F.col("category_id").alias("class"))


def _tags(t):
    return filters.item_tags(t.latest_catalog()).select("item_id", F.col("tag").alias("class"))


define("tag_map", "latest", """SELECT DISTINCT item_id, CAST(unnest(from_json(tagids, '["VARCHAR"]')) AS INTEGER) AS class FROM latest""")
define("class_downloads", "track latest pool", """SELECT category_id AS class, d.item_id, CAST(count(*) AS DOUBLE) AS score FROM
    (SELECT DISTINCT user_id, item_id, date FROM track WHERE action = 'download_install' AND item_id IN (SELECT item_id FROM pool)) d
    JOIN latest l ON d.item_id = l.item_id GROUP BY ALL""")


@query("hot_in_category", f"""SELECT 'hot_in_' || class AS list_id, CAST(item_id AS VARCHAR) AS item, score FROM class_downloads {_CUT.format(200)}""",
       "class_downloads")
def _(t):
    return hot.hot_in_class(t.track(), _classes(t), _pool(t), "hot_in_")


@query("hot_categories", """SELECT 'hot_categories' AS list_id, CAST(class AS VARCHAR) AS item, sum(score) AS score FROM class_downloads
    GROUP BY class ORDER BY score DESC, item LIMIT 100""", "class_downloads")
def _(t):
    return hot.hot_classes(t.track(), _classes(t), _pool(t), "hot_categories")


@query("hot_json_filtered", """SELECT 'hot_video' AS list_id, CAST(item_id AS VARCHAR) AS item, CAST(count(DISTINCT user_id) AS DOUBLE) AS score
    FROM track WHERE action = 'activate' AND item_id IN (SELECT item_id FROM latest WHERE publisher = 'ECONOMY' OR publisher = 'PROMO')
    AND item_id IN (SELECT item_id FROM pool) GROUP BY item_id ORDER BY score DESC, item LIMIT 200""", "track latest pool")
def _(t):
    portrait = F.when(F.col("publisher").isin("ECONOMY", "PROMO"), 1).otherwise(0)
    video = F.to_json(F.struct(F.struct(portrait.alias("screenType")).alias("en")))
    items = t.latest_catalog().select("item_id", video.alias("video"))
    return hot.hot_where_json(t.track(), items, "video", "$.en.screenType", "1", "hot_video", "activate", allow=_pool(t))


# One week of user counts per item: floors far below the defaults suit the density of the test log.
_TODAY, _BEFORE = "20240121", ("20240114", "20240120")
define("trend", "track", """SELECT CAST(item_id AS VARCHAR) AS item, t / (b / 7) AS score FROM (SELECT item_id,
    count(DISTINCT user_id) FILTER (date = '20240121') AS t, count(DISTINCT user_id) FILTER (date BETWEEN '20240114' AND '20240120') AS b
    FROM track WHERE action = 'item_click' GROUP BY item_id) WHERE t >= 1 AND b > 1 AND t / (b / 7) >= 1.2""")


def _trend(t, day=_TODAY, before=_BEFORE):
    rows = hot.trending(t.track(), day, before, 7, 0.2, action="item_click", floor_today=1, floor_before=1)
    return rows.select(F.col("item_id").cast("string").alias("item"), F.col("ratio").alias("score"))


@query("trending_items", """SELECT 'trending' AS list_id, item, round(score, 6) AS score FROM trend ORDER BY round(score, 12) DESC, item LIMIT 200""", "trend")
def _(t):
    rows = _trend(t).withColumn("score", F.round("score", 12))
    return hot.list_of(rows, "trending", "item", "score", 200).withColumn("score", F.round("score", 6))


@query("trending_merged", """WITH days AS (SELECT DISTINCT date AS day FROM track WHERE date BETWEEN '20240114' AND '20240121'),
    counts AS (SELECT day, item_id, count(DISTINCT user_id) FILTER (date = day) AS t,
        count(DISTINCT user_id) FILTER (date < day AND date >= strftime(strptime(day, '%Y%m%d') - INTERVAL 7 DAY, '%Y%m%d')) AS b
        FROM track, days WHERE action = 'item_click' GROUP BY day, item_id),
    lists AS (SELECT item_id, t / (b / 7) AS score FROM counts WHERE t >= 1 AND b > 1 AND t / (b / 7) >= 1.2)
    SELECT 'trending_week' AS list_id, CAST(item_id AS VARCHAR) AS item, round(max(score), 6) AS score FROM lists GROUP BY item_id
    ORDER BY round(max(score), 12) DESC, item LIMIT 200""", "track")
def _(t):
    days = [day_shift(_TODAY, -back) for back in range(8)]
    rows = hot.trending_days(t.track(), days, 7, 0.2, action="item_click", floor_today=1, floor_before=1)
    best = rows.groupBy("item_id").agg(F.round(F.max("ratio"), 12).alias("score"))
    return hot.list_of(best, "trending_week", "item_id", "score", 200).withColumn("score", F.round("score", 6))


def _cold_sql(bound: str, pool: str = "") -> str:
    return f"""WITH p AS (SELECT item_id, 'cold_S_' || CASE WHEN category_id >= 100 THEN 'game' ELSE 'app' END AS list_id FROM latest WHERE level = 'S'{pool}),
    f AS (SELECT list_id, p.item_id, user_id, max(CASE WHEN page = 'recommend' AND action = 'item_exposure' THEN 1 ELSE 0 END) AS s,
        max(CASE WHEN page LIKE '%detail%' AND action = 'download_install' AND install_status = 'download_request'
            AND install_type IN ('manual_install', 'auto_install') THEN 1 ELSE 0 END) AS d
        FROM track t JOIN p ON t.item_id = p.item_id GROUP BY ALL),
    i AS (SELECT p.list_id, p.item_id, coalesce(sum(s), 0) AS seen, coalesce(sum(d), 0) AS got FROM p LEFT JOIN f ON p.item_id = f.item_id GROUP BY ALL),
    g AS (SELECT i.list_id, count(*) AS size, sum(got) AS all_got, max(u) AS users FROM i LEFT JOIN
        (SELECT list_id, count(DISTINCT user_id) AS u FROM f WHERE s = 1 GROUP BY list_id) x ON i.list_id = x.list_id GROUP BY i.list_id),
    scored AS (SELECT i.list_id, item_id, seen, CASE WHEN seen = 0 THEN 10000.0 WHEN got > 0 THEN {bound} END AS score,
        all_got / users AS overall FROM i JOIN g ON i.list_id = g.list_id)
    SELECT list_id, CAST(item_id AS VARCHAR) AS item, round(score, 6) AS score FROM scored WHERE score IS NOT NULL AND (seen = 0 OR score > overall)
    QUALIFY row_number() OVER (PARTITION BY list_id ORDER BY round(score, 12) DESC, item) <= 1000"""


def _cold_pool(t):
    """One list for apps and one for games."""
    kind = F.when(F.col("category_id") >= FIRST_GAME, "game").otherwise("app")
    return t.latest_catalog().where(F.col("level") == "S").select("item_id", kind.alias("list_id"))


@query("cold_start_ucb", _cold_sql("got / seen + log10((users / size / 10) / seen)"), "track latest")
def _(t):
    return hot.cold_start(t.track(), _cold_pool(t), "cold_S", 1000).withColumn("score", F.round("score", 6))


@query("cold_start_ucb_v2", _cold_sql("CASE WHEN users / size >= 1 THEN got / seen + sqrt(log10(users / size) / seen) END",
                                      " AND item_id IN (SELECT item_id FROM track)"), "track latest")
def _(t):
    return hot.cold_start(t.track(), _cold_pool(t), "cold_S", 1000, formula="sqrt", scale=1, only_logged=True).withColumn("score", F.round("score", 6))


define("recalled", "recall_hits", """SELECT DISTINCT CAST(item_id AS BIGINT) AS item_id FROM (SELECT item_id, count(*) AS n, max(channel) AS c
    FROM recall_hits WHERE slot = 2 GROUP BY user_id, mark, item_id, time_ms) WHERE n > 1 OR c <> 'q1'""")
define("no_recall_scores", "track denied", """SELECT item_id, date, count(DISTINCT user_id) AS score FROM track
    WHERE action = 'activate' AND item_id NOT IN (SELECT item_id FROM denied) GROUP BY ALL""")


def _recalled(t):
    return hot.recalled_items(logs.recall_channels(t.recall_log(), [2]), "q1").select(F.col("item_id").cast("long").alias("item_id"))


def _no_recall(t, level, name, by_category=False, day=None):
    log = t.track() if day is None else t.track().where(F.col("date") == day)
    scores = hot.item_users(log, "activate", deny=t.denied_items())
    return hot.no_recall(t.latest_catalog(), _recalled(t), scores, level, name, by_category)


define("unrecalled", "no_recall_scores recalled latest track denied", """SELECT l.item_id, l.level, l.category_id, s.n AS score FROM latest l
    JOIN (SELECT item_id, count(DISTINCT user_id) AS n FROM track WHERE action = 'activate'
        AND item_id NOT IN (SELECT item_id FROM denied) GROUP BY item_id) s ON l.item_id = s.item_id
    WHERE l.item_id NOT IN (SELECT item_id FROM recalled)""")


@query("no_recall_items", """SELECT 'unrecalled_' || level AS list_id, CAST(item_id AS VARCHAR) AS item, CAST(score AS DOUBLE) AS score
    FROM unrecalled WHERE level = 'S'""", "unrecalled")
def _(t):
    return _no_recall(t, "S", "unrecalled")


@query("no_recall_by_category", """SELECT 'unrecalled_' || level || '_' || category_id AS list_id, CAST(item_id AS VARCHAR) AS item,
    CAST(score AS DOUBLE) AS score FROM unrecalled WHERE level = 'A'""", "unrecalled")
def _(t):
    return _no_recall(t, "A", "unrecalled", by_category=True)


@query("no_recall_7d", """SELECT 'unrecalled_S' AS list_id, CAST(s.item_id AS VARCHAR) AS item, CAST(sum(score) AS DOUBLE) AS score
    FROM no_recall_scores s JOIN latest l ON s.item_id = l.item_id WHERE level = 'S' AND s.date BETWEEN '20240124' AND '20240130'
    AND s.item_id NOT IN (SELECT item_id FROM recalled) GROUP BY s.item_id""", "no_recall_scores latest recalled")
def _(t):
    # Seven daily lists added up, as one aggregate over the dated scores.
    from ..operators.filters import allow_deny

    week = t.track().where(F.col("date").between(day_shift(AS_OF, -7), NEW_SNAPSHOT) & (F.col("action") == "activate"))
    daily = allow_deny(week, "item_id", deny=t.denied_items()).groupBy("item_id", "date").agg(F.count_distinct("user_id").alias("score"))
    return hot.sum_lists(hot.no_recall(t.latest_catalog(), _recalled(t), daily, "S", "unrecalled"))


_RATE = """WITH days AS (SELECT DISTINCT user_id, item_id, action, date FROM track WHERE action IN ('item_exposure', 'item_click')),
    sums AS (SELECT user_id, m.class, 1 + count(*) FILTER (action = 'item_exposure') AS e, count(*) FILTER (action = 'item_click') AS c
        FROM days JOIN {map} m ON days.item_id = m.item_id GROUP BY ALL),
    scored AS (SELECT user_id, class, """ + wilson_sql("c", "e") + """ AS score FROM sums WHERE c <= e)
    SELECT user_id, {cols}, round(score, 6) AS score FROM scored WHERE score > 0
    QUALIFY row_number() OVER (PARTITION BY user_id{part} ORDER BY round(score, 12) DESC, class) <= {n}"""
define("category_map", "latest", "SELECT item_id, category_id AS class FROM latest")


def _twelve(df):
    return df.withColumn("score", F.round("score", 12))


@query("user_hot_category", _RATE.format(map="category_map", cols="CASE WHEN class >= 100 THEN 'game' ELSE 'app' END AS kind, class",
                                         part=", class >= 100", n=10), "track category_map")
def _(t):
    rates = _twelve(hot.user_class_rate(t.track(), _classes(t)))
    return hot.favourite_categories(rates).select("user_id", "kind", "class", r6("score"))


@query("user_hot_category_install", """SELECT user_id, CASE WHEN class >= 100 THEN 'game' ELSE 'app' END AS kind, class, CAST(count(*) AS DOUBLE) AS score
    FROM track JOIN category_map USING (item_id) WHERE action = 'install' GROUP BY user_id, class
    QUALIFY row_number() OVER (PARTITION BY user_id, class >= 100 ORDER BY count(*) DESC, class) <= 10""", "track category_map")
def _(t):
    return hot.favourite_categories(hot.user_class_counts(t.track(), _classes(t))).select("user_id", "kind", "class", "score")


@query("user_hot_tag", _RATE.format(map="tag_map", cols="class", part="", n=100), "track tag_map")
def _(t):
    return hot.favourite_classes(_twelve(hot.user_class_rate(t.track(), _tags(t)))).select("user_id", "class", r6("score"))


@query("user_category_weighted", """SELECT user_id, class, count(*) FILTER (action IN ('item_click', 'download_install')) / 4
        + count(*) FILTER (action = 'install') / 2 AS score FROM track JOIN category_map USING (item_id)
    WHERE user_id IN (SELECT user_id FROM track WHERE action = 'download_install' GROUP BY user_id, date HAVING count(DISTINCT item_id) <= 200)
    GROUP BY user_id, class QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, class) <= 10""", "track category_map")
def _(t):
    return hot.weighted_categories(t.track(), _classes(t), 10, most_downloads=200)


def usage(t):
    """``user_id, item_id, frequency, duration``: one row per event."""
    return t.track().select("user_id", "item_id", (F.col("hour") + 1).cast("double").alias("frequency"), F.col("value").alias("duration"))


define("usage_scores", "track", """SELECT user_id, item_id, 5 * avg(value) + 3 * avg(hour + 1) AS score FROM track GROUP BY user_id, item_id
    HAVING avg(value) > 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) <= 10""")


@query("user_top_usage", "SELECT user_id, item_id, round(score, 6) AS score FROM usage_scores", "usage_scores")
def _(t):
    return hot.top_usage(usage(t)).select("user_id", "item_id", r6("score"))


define("knn_rows", "vectors", """SELECT a.id, b.id AS item, round(list_distance(a.vector, b.vector), 12) AS distance
    FROM vectors a JOIN vectors b ON a.id <> b.id QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY distance, b.id) <= 120""")


def _knn_rows(t):
    """The rows of an external neighbour file: id, distance, item, best 120 by Euclidean distance."""
    near = knn(t.vectors(), 120, "euclidean").withColumnRenamed("score", "distance")
    return near.select("id", F.round("distance", 12).alias("distance"), "item")


_LISTS = """SELECT id, item, round(100 - distance, 6) AS score, CAST(row_number() OVER (PARTITION BY id ORDER BY 100 - distance DESC, item) AS INTEGER) AS rank
    FROM knn_rows WHERE item IN (SELECT id FROM vectors WHERE label <> 3){more} QUALIFY rank <= 100"""


def _file_lists(t, limit=None):
    allow = t.table("embeddings").where(F.col("label") != 3).select(F.col("vec_id").cast("string").alias("id"))
    rows = hot.knn_rows_to_lists(_knn_rows(t), max_distance=limit, allow=allow, base=100.0)
    return rows.select("id", "item", r6("score"), "rank")


@query("knn_file_to_i2i", _LISTS.format(more=""), "vectors knn_rows")
def _(t):
    return _file_lists(t)


@query("knn_file_truncated", _LISTS.format(more=" AND distance <= 1.1"), "vectors knn_rows")
def _(t):
    return _file_lists(t, 1.1)
