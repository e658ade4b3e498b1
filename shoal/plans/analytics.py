"""Similarity, graphs, embeddings, clusters and sampling."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import cf, cluster, graph, hot, neighbours, products, sampling, textsim
from ..operators.topn import i2i_top_n
from .aggregates import keyword_log
from .base import query, r6
from .sqltext import define, draw, u01


@query("itemcf_v1", "SELECT item_1, item_2, round(sim, 6) AS sim FROM itemcf", "itemcf")
def _(t):
    return cf.item_cf(t.ratings()).withColumn("sim", F.round("sim", 6))


@query("itemcf_v2", """WITH s AS (SELECT user_id, sqrt(count(DISTINCT item_id)) AS w FROM ratings GROUP BY user_id),
    n AS (SELECT item_id, sqrt(sum(score * score)) AS norm FROM ratings GROUP BY item_id),
    d AS (SELECT a.item_id AS item_1, b.item_id AS item_2, sum(a.score * b.score / w) AS dot FROM ratings a JOIN ratings b
        ON a.user_id = b.user_id AND a.item_id < b.item_id JOIN s ON a.user_id = s.user_id GROUP BY ALL)
    SELECT item_1, item_2, round(dot / (x.norm * y.norm), 6) AS sim FROM d JOIN n x ON item_1 = x.item_id JOIN n y ON item_2 = y.item_id""", "ratings")
def _(t):
    return cf.item_cf(t.ratings(), "V2").withColumn("sim", F.round("sim", 6))


@query("itemcf_pairs", "SELECT item_1, item_2, round(sim, 6) AS sim FROM itemcf", "itemcf")
def _(t):
    """All pairs, as an input of other operators."""
    return cf.item_cf(t.ratings()).withColumn("sim", F.round("sim", 6))


def _swing_cte(source: str) -> str:
    return f"""SELECT p.item_1, p.item_2, p.user_id AS u, q.user_id AS v, p.si AS ui, p.sj AS uj, q.si AS vi, q.sj AS vj, p.k AS ku, q.k AS kv,
        1 / (1.0::DOUBLE + count(*) OVER (PARTITION BY p.user_id, q.user_id)) AS w
    FROM {source} p JOIN {source} q ON p.item_1 = q.item_1 AND p.item_2 = q.item_2 AND p.user_id <= q.user_id"""


def _pairs_cte(source: str) -> str:
    return f"""SELECT a.user_id, a.item_id AS item_1, b.item_id AS item_2, a.score AS si, b.score AS sj, s.k
    FROM {source} a JOIN {source} b ON a.user_id = b.user_id AND a.item_id < b.item_id
    JOIN (SELECT user_id, CAST(count(*) AS DOUBLE) AS k FROM {source} GROUP BY user_id) s ON a.user_id = s.user_id"""


define("user_pairs", "ratings", _pairs_cte("ratings"))
define("swing_rows", "user_pairs", _swing_cte("user_pairs"))
define("item_norms", "ratings", "SELECT item_id, sqrt(sum(score * score)) AS norm FROM ratings GROUP BY item_id")
_SWING = "SELECT item_1, item_2, round(sum({}), 6) AS sim FROM swing_rows GROUP BY item_1, item_2"
_SWING_NORM = """SELECT item_1, item_2, round(s / sqrt(x.norm * y.norm), 6) AS sim FROM (SELECT item_1, item_2, sum({}) AS s FROM swing_rows GROUP BY ALL)
    JOIN item_norms x ON item_1 = x.item_id JOIN item_norms y ON item_2 = y.item_id"""

for _version, _sql in {
    "V1": _SWING.format("w"), "V1p1": _SWING_NORM.format("w * (ui * vi + uj * vj)"), "V2": _SWING.format("w / sqrt(ku * kv)"),
    "V3": _SWING_NORM.format("w / sqrt(ku * kv) * (ui * uj + vi * vj)"),
}.items():
    query(f"swing_{_version.lower()}", _sql, "swing_rows item_norms")(
        lambda t, version=_version: cf.swing(t.ratings(), version).withColumn("sim", F.round("sim", 6)))


define("kw_pairs", "keyword_v2", _pairs_cte("(SELECT * FROM keyword_v2 WHERE score > 0)"))
define("kw_swing_rows", "kw_pairs", _swing_cte("kw_pairs"))
define("kw_swing", "kw_swing_rows", "SELECT item_1, item_2, sum(w) AS sim FROM kw_swing_rows GROUP BY ALL")
define("behaviour_ratings", "behaviour_kept", """SELECT user_id, CAST(item_id AS VARCHAR) AS item_id,
    CAST(sum(CASE action WHEN 'download_install' THEN 2 ELSE 3 END) AS DOUBLE) AS score FROM behaviour_kept GROUP BY user_id, item_id""")
define("bh_pairs", "behaviour_ratings", _pairs_cte("behaviour_ratings"))
define("bh_swing_rows", "bh_pairs", _swing_cte("bh_pairs"))
define("bh_swing", "bh_swing_rows", "SELECT item_1, item_2, sum(w) AS sim FROM bh_swing_rows GROUP BY ALL")
_MIRROR = """SELECT id, item, round(score, 6) AS score FROM (SELECT item_1 AS id, item_2 AS item, sim AS score FROM {t}
    UNION ALL SELECT item_2, item_1, sim FROM {t}) WHERE {cond} QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(score, 12) DESC, item) <= {n}"""
_ALLOWED = "item IN (SELECT CAST(item_id AS VARCHAR) FROM pool) AND item NOT IN (SELECT CAST(item_id AS VARCHAR) FROM denied)"


def _keyword_ratings(t):
    return hot.keyword_scores(keyword_log(t), "downloads", times=100, users=(1, 500), items=(1, 10_000))


def _pool(t):
    return t.latest_catalog().where(F.col("level") != "D").select("item_id")


def _twelve(df):
    return df.withColumn("sim", F.round("sim", 12))


@query("swing_query_i2i", _MIRROR.format(t="kw_swing", cond=_ALLOWED, n=30), "kw_swing pool denied")
def _(t):
    lists = i2i_top_n(_twelve(cf.swing(_keyword_ratings(t))), 30, allow=_pool(t), deny=t.denied_items())
    return lists.select("id", "item", r6("score"))


@query("swing_merged_i2i", """WITH both_swings AS (SELECT item_1, item_2, sum(sim) AS sim FROM (SELECT * FROM kw_swing UNION ALL SELECT * FROM bh_swing) GROUP BY ALL)
    """ + _MIRROR.format(t="both_swings", cond="round(score, 12) >= 0.1 AND " + _ALLOWED, n=100), "kw_swing bh_swing pool denied")
def _(t):
    searched = cf.swing(_keyword_ratings(t))
    used = cf.swing(hot.behaviour_scores(t.track(), hot.ACTION_WEIGHTS, users=(1, 50), items=(1, 10_000)))
    lists = i2i_top_n(_twelve(cf.merge_similarities(searched, used)), 100, min_score=0.1, allow=_pool(t), deny=t.denied_items())
    return lists.select("id", "item", r6("score"))


_NEAR = """SELECT a.id, b.id AS item, round({d}(a.vector, b.vector), 6) AS score FROM vectors a JOIN vectors b ON a.id <> b.id{on}
    QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY round({d}(a.vector, b.vector), 12) {o}, b.id) <= 20"""


@query("knn_cosine", _NEAR.format(d="list_cosine_similarity", o="DESC", on=""), "vectors")
def _(t):
    return neighbours.knn(t.vectors(), 20).select("id", "item", r6("score"))


@query("knn_euclidean", _NEAR.format(d="list_distance", o="ASC", on=" AND list_distance(a.vector, b.vector) <= 1.2"), "vectors")
def _(t):
    return neighbours.knn(t.vectors(), 20, "euclidean", max_distance=1.2).select("id", "item", r6("score"))


@query("knn_directed", _NEAR.format(d="list_cosine_similarity", o="DESC", on=" AND b.label IN (1, 2, 3) AND b.label <> 2"), "vectors")
def _(t):
    ids = lambda cond: t.table("embeddings").where(cond).select(F.col("vec_id").cast("string").alias("id"))
    lists = neighbours.knn(t.vectors(), 20, allow=ids(F.col("label").isin(1, 2, 3)), deny=ids(F.col("label") == 2))
    return lists.select("id", "item", r6("score"))


@query("knn_cosine_list", """WITH near AS (SELECT a.id, b.id AS item, round(list_cosine_similarity(a.vector, b.vector), 12) AS score FROM vectors a JOIN vectors b ON a.id <> b.id
        QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY score DESC, b.id) <= 100)
    SELECT id, string_agg(item || '&' || printf('%.6f', score), ',' ORDER BY score DESC, item) AS value FROM near GROUP BY id""", "vectors")
def _(t):
    return neighbours.neighbour_text(neighbours.knn(t.vectors()))


define("lsh_near", "vectors", f"""WITH planes AS (SELECT p, list(CAST(1 - 2 * ({draw('lsh', 'p', 'd')} % 2) AS DOUBLE) ORDER BY d) AS plane FROM
        (SELECT range AS p FROM range(10)), (SELECT unnest(range((SELECT max(len(vector)) FROM vectors))) AS d) GROUP BY p),
    val AS (SELECT id, p // 5 AS t, CAST(p % 5 AS INTEGER) AS b, list_inner_product(CAST(vector AS DOUBLE[]), plane) AS v FROM vectors, planes),
    sig AS (SELECT id, t, CAST(sum(CASE WHEN v >= 0 THEN 1 << b ELSE 0 END) AS BIGINT) AS bucket FROM val GROUP BY ALL),
    flip AS (SELECT id, t, mask, round(sum(CASE WHEN (mask >> b) & 1 = 1 THEN abs(v) ELSE 0 END), 9) AS s FROM val, range(32) m(mask) GROUP BY id, t, mask
        QUALIFY row_number() OVER (PARTITION BY id, t ORDER BY s, mask) <= 16),
    look AS (SELECT f.id, f.t, xor(bucket, mask) AS bucket FROM flip f JOIN sig s ON f.id = s.id AND f.t = s.t),
    met AS (SELECT DISTINCT x.id, y.id AS item FROM look x JOIN sig y ON x.t = y.t AND x.bucket = y.bucket AND x.id <> y.id)
    SELECT m.id, m.item, list_cosine_similarity(a.vector, b.vector) AS score FROM met m JOIN vectors a ON a.id = m.id JOIN vectors b ON b.id = m.item
        QUALIFY row_number() OVER (PARTITION BY m.id ORDER BY round(list_cosine_similarity(a.vector, b.vector), 12) DESC, m.item) <= 10""")
_LSH = neighbours.Probing(bits=5, tables=2, probes=16, recall=None)


def _lsh(t):
    return neighbours.knn_lsh(t.vectors(), 10, _LSH.bits, _LSH.tables, _LSH.probes, seed="lsh")


@query("knn_lsh", "SELECT id, item, round(score, 6) AS score FROM lsh_near", "lsh_near")
def _(t):
    return _lsh(t).select("id", "item", r6("score"))


@query("knn_lsh_recall", """WITH exact AS (SELECT a.id, b.id AS item FROM vectors a JOIN vectors b ON a.id <> b.id
        QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY round(list_cosine_similarity(a.vector, b.vector), 12) DESC, b.id) <= 10)
    SELECT round(count(f.id) / count(*), 6) AS recall, count(*) AS wanted FROM exact e LEFT JOIN lsh_near f ON e.id = f.id AND e.item = f.item""", "vectors lsh_near")
def _(t):
    return neighbours.recall_against(_lsh(t), neighbours.knn(t.vectors(), 10)).select(r6("recall"), "wanted")


_TFIDF = """SELECT id, term, tf * ln(((SELECT count(*) FROM texts) + 1) / (df + 1)) AS weight FROM
    (SELECT id, term, count(*) AS tf FROM (SELECT id, {term} AS term FROM (SELECT id, unnest(words) AS word FROM texts)) GROUP BY ALL)
    JOIN (SELECT term, count(DISTINCT id) AS df FROM (SELECT id, {term} AS term FROM (SELECT id, unnest(words) AS word FROM texts)) GROUP BY term) USING (term)"""
define("tfidf", "texts", _TFIDF.format(term="word"))
define("tfidf_buckets", "texts", _TFIDF.format(term=f"CAST({draw('bucket', 'word')} % 4096 AS BIGINT)"))


_TFIDF_TOP = """WITH n AS (SELECT id, sqrt(sum(weight * weight)) AS norm FROM {tfidf} GROUP BY id HAVING sum(weight * weight) > 0),
    u AS (SELECT t.id, term, weight / norm AS w FROM {tfidf} t JOIN n ON t.id = n.id WHERE weight <> 0),
    s AS (SELECT a.id, b.id AS item, round(sum(a.w * b.w), 12) AS score FROM u a JOIN u b ON a.term = b.term AND a.id <> b.id GROUP BY ALL)
    SELECT id, item, round(score, 6) AS score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, item) <= 10"""


@query("tfidf_topn", _TFIDF_TOP.format(tfidf="tfidf"), "tfidf")
def _(t):
    return textsim.tfidf_top_n(t.texts(), 10).select("id", "item", r6("score"))


@query("tfidf_hashed", _TFIDF_TOP.format(tfidf="tfidf_buckets"), "tfidf_buckets")
def _(t):
    return textsim.tfidf_top_n(t.texts(), 10, features=4096).select("id", "item", r6("score"))


@query("als_topk", """SELECT user_id, count(*) AS ratings, least(10, (SELECT count(DISTINCT item_id) FROM ratings)) AS listed, true AS in_order,
    true AS solved FROM ratings GROUP BY user_id""", "ratings")
def _(t):
    """The lists, and whether each user's factor solves its equations: what holds for any factorisation, so that SQL can say it."""
    users, items = cf.als_factors(t.ratings(), rank=8, max_iter=3)
    lists = products.top_by_product(users, items, 10)
    falls = F.lag("score").over(Window.partitionBy("id").orderBy("rank")) >= F.col("score")
    listed = (lists.withColumn("falls", F.coalesce(falls, F.lit(True))).groupBy(F.col("id").alias("user_id"))
              .agg(F.count_distinct("item").alias("listed"), F.every("falls").alias("in_order")))
    solved = cf.als_residuals(t.ratings(), users, items, rank=8, reg=0.1)
    return solved.join(listed, "user_id").select("user_id", "ratings", "listed", "in_order", (F.col("residual") < 1e-3).alias("solved"))


def _item_positions(t):
    return graph.item_positions(t.track().select("user_id", "item_id", "time_ms"), "user_id", "item_id", "time_ms")


@query("word2vec_items", """SELECT CAST(item_id AS VARCHAR) AS item, count(*) AS n, 16 AS length, true AS usable
    FROM track GROUP BY item_id HAVING count(*) >= 5""", "track")
def _(t):
    """Vocabulary and counts; of the vectors what holds for any training: their length, and that they are numbers and not all 0."""
    vectors = graph.item_vectors(t.track(), "user_id", "item_id", "time_ms", min_count=5, size=16)
    usable = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0)
    return vectors.select("item", "n", F.size("vector").alias("length"), usable.alias("usable"))


@query("graph_node_index", """WITH n AS (SELECT src AS node FROM edges UNION SELECT dst FROM edges)
    SELECT count(*) AS nodes, 0 AS lowest, CAST(count(*) - 1 AS INTEGER) AS highest, count(*) AS different FROM n""", "edges")
def _(t):
    index = graph.node_index(graph.edges_of(t.edges()))
    return index.agg(F.count("*").alias("nodes"), F.min("index").alias("lowest"), F.max("index").alias("highest"),
                     F.count_distinct("index").alias("different"))


define("both_ways", "edges", "SELECT src, dst, sum(weight) AS weight FROM (SELECT * FROM edges UNION ALL SELECT dst, src, weight FROM edges) GROUP BY ALL")
define("intervals", "both_ways", """SELECT src, dst, (upto - weight) / total AS low, upto / total AS high FROM (SELECT src, dst, weight,
    sum(weight) OVER (PARTITION BY src ORDER BY substr(md5(dst), 1, 2), dst) AS upto, sum(weight) OVER (PARTITION BY src) AS total FROM both_ways)""")


def _walk_sql(seed: str, steps: int) -> str:
    parts = ["s0 AS (SELECT DISTINCT src AS walk, src AS node FROM both_ways)"]
    for i in range(steps):
        u = u01(seed, "s.walk", f"'{i}a'")
        parts.append(f"s{i + 1} AS (SELECT s.walk, x.dst AS node FROM s{i} s JOIN intervals x ON s.node = x.src AND {u} >= x.low AND {u} < x.high)")
    rows = " UNION ALL ".join(f"SELECT walk, {i} AS pos, node FROM s{i}" for i in range(steps + 1))
    return f"WITH {', '.join(parts)} SELECT walk, CAST(pos AS INTEGER) AS pos, node FROM ({rows}) WHERE node IN (SELECT dst FROM edges)"


@query("deepwalk", _walk_sql("walk", 4), "edges intervals")
def _(t):
    return graph.deep_walk(t.edges(), seq_length=3, seed="walk")


def _bfs_sql(seed: str, steps: int, ratio: float) -> str:
    parts = ["s0 AS (SELECT DISTINCT src AS walk, src AS node FROM both_ways)"]
    rows = ["SELECT walk, 0 AS pos, node FROM s0"]
    for i in range(steps):
        u, v, c = (u01(seed, "s.walk", f"'{i}{x}'") for x in "abc")
        parts.append(f"""s{i + 1} AS (SELECT s.walk, x.dst AS first, y.dst AS second, coalesce(y.dst, x.dst) AS node FROM s{i} s
            JOIN intervals x ON s.node = x.src AND {u} >= x.low AND {u} < x.high
            LEFT JOIN intervals y ON s.node = y.src AND {v} >= y.low AND {v} < y.high AND {c} >= {ratio})""")
        rows.append(f"SELECT walk, {2 * i + 1}, first FROM s{i + 1}")
        rows.append(f"SELECT walk, {2 * i + 2}, second FROM s{i + 1} WHERE second IS NOT NULL")
    return f"WITH {', '.join(parts)} SELECT walk, CAST(pos AS INTEGER) AS pos, node FROM ({' UNION ALL '.join(rows)})"


@query("deepwalk_bfs", _bfs_sql("bfs", 4, 0.5), "edges intervals")
def _(t):
    return graph.deep_walk(t.edges(), seq_length=3, mode="dfs&bfs", keep="all", seed="bfs")


define("second_order", "both_ways", """SELECT a.src AS prev, a.dst AS cur, b.dst AS next, b.weight,
    CASE WHEN a.src = b.dst THEN 'back' WHEN k.src IS NOT NULL THEN 'shared' ELSE 'far' END AS kind
    FROM both_ways a JOIN both_ways b ON a.dst = b.src LEFT JOIN both_ways k ON k.src = a.src AND k.dst = b.dst""")


@query("node2vec_edge_probs", """SELECT prev, cur, kind, count(*) AS n, round(sum(CASE kind WHEN 'back' THEN weight / 2 WHEN 'shared' THEN weight ELSE weight / 0.5 END), 6) AS weight
    FROM second_order GROUP BY prev, cur, kind""", "second_order")
def _(t):
    rows = graph.edge_probabilities(t.edges(), directed=False, p=2.0, q=0.5, summed=True)
    return rows.select("prev", "cur", "kind", "n", r6("weight"))


def _node2vec_sql(seed: str, steps: int, draws: int = 100) -> str:
    """Every walk's first accepted draw; the chance that all ``draws`` are refused is below 1e-12 (a quarter is the least factor)."""
    parts = ["s0 AS (SELECT DISTINCT src AS walk, NULL::VARCHAR AS prev, src AS cur FROM both_ways)",
             "many AS (SELECT src, count(*) AS edges FROM both_ways GROUP BY src)"]
    for i in range(steps):
        u, coin = u01(seed, "s.walk", str(i), "draw"), u01(seed, "s.walk", str(i), "draw", "'coin'")
        known, taken = "", "true"
        if i:
            known = "LEFT JOIN both_ways k ON k.src = s.prev AND k.dst = x.dst"
            taken = f"(edges = 1 OR {coin} * 2 < CASE WHEN x.dst = s.prev THEN 0.5 WHEN k.src IS NOT NULL THEN 1 ELSE 2 END)"
        parts.append(f"""s{i + 1} AS MATERIALIZED (SELECT s.walk, s.cur AS prev, arg_min(x.dst, draw) AS cur
            FROM s{i} s JOIN many m ON m.src = s.cur, range({draws if i else 1}) d(draw)
            JOIN intervals x ON s.cur = x.src AND {u} >= x.low AND {u} < x.high {known} WHERE {taken} GROUP BY s.walk, s.cur)""")
    rows = " UNION ALL ".join(f"SELECT walk, {i} AS pos, cur AS node FROM s{i}" for i in range(steps + 1))
    return f"WITH {', '.join(parts)} SELECT walk, CAST(pos AS INTEGER) AS pos, node FROM ({rows}) WHERE node IN (SELECT dst FROM edges)"


@query("node2vec", _node2vec_sql("n2v", 3), "edges intervals")
def _(t):
    return graph.node2vec_walks(t.edges(), seq_length=2, directed=False, p=2.0, q=0.5, seed="n2v")


@query("skipgram_pairs", """WITH o AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY time_ms, item_id) AS i FROM track)
    SELECT CAST(a.item_id AS VARCHAR) AS centre, CAST(b.item_id AS VARCHAR) AS context, count(*) AS n
    FROM o a JOIN o b ON a.user_id = b.user_id AND a.i <> b.i AND abs(a.i - b.i) <= 2 GROUP BY ALL""", "track")
def _(t):
    return graph.skip_gram_pairs(_item_positions(t), 2).groupBy("centre", "context").agg(F.count("*").alias("n"))


_WALK_PAIRS = """WITH walks AS MATERIALIZED ({walks}) SELECT a.node AS centre, b.node AS context, count(*) AS n
    FROM walks a JOIN walks b ON a.walk = b.walk AND a.pos <> b.pos AND abs(a.pos - b.pos) <= 2 GROUP BY ALL"""


@query("skipgram_deepwalk", _WALK_PAIRS.format(walks=_walk_sql("walk", 4)), "edges intervals")
def _(t):
    return _walk_pairs(graph.deep_walk(t.edges(), seq_length=3, seed="walk"))


@query("skipgram_node2vec", _WALK_PAIRS.format(walks=_node2vec_sql("n2v", 3)), "edges intervals")
def _(t):
    return _walk_pairs(graph.node2vec_walks(t.edges(), seq_length=2, directed=False, p=2.0, q=0.5, seed="n2v"))


def _walk_pairs(walks):
    return graph.skip_gram_pairs(walks, 2).groupBy("centre", "context").agg(F.count("*").alias("n"))


def _kmeans_sql(seed: str, ks: list[int], rounds: int) -> str:
    """The rounds one by one, all k together; ``q`` holds points as (id, place, number)."""
    parts = [f"d AS (SELECT id, row_number() OVER (ORDER BY {draw(seed, 'id')}, id) - 1 AS c FROM vectors)",
             "ks AS (SELECT unnest([" + ", ".join(map(str, ks)) + "]) AS k)",
             "c0 AS MATERIALIZED (SELECT k, c, vector AS centre FROM ks JOIN d ON c < k JOIN vectors USING (id))"]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT id, k, c, own, other FROM (SELECT id, k, c, dist AS own, lead(dist) OVER w AS other, row_number() OVER w AS r
            FROM (SELECT id, k, c, list_distance(vector, centre) AS dist FROM vectors, c{r}) WINDOW w AS (PARTITION BY id, k ORDER BY dist, c)) WHERE r = 1)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT o.k, o.c, coalesce(m.centre, o.centre) AS centre FROM c{r} o LEFT JOIN (SELECT k, c, list(m ORDER BY i) AS centre
                FROM (SELECT k, c, i, avg(x) AS m FROM a{r} JOIN (SELECT id, unnest(vector) AS x, generate_subscripts(vector, 1) AS i FROM vectors) USING (id) GROUP BY k, c, i)
                GROUP BY k, c) m ON o.k = m.k AND o.c = m.c)""")
    return f"""WITH {', '.join(parts)},
    s AS (SELECT k, avg(CASE WHEN greatest(own, other) > 0 THEN (other - own) / greatest(own, other) ELSE 0 END) AS score FROM a{rounds} GROUP BY k)
    SELECT a.id, CAST(a.k AS INTEGER) AS k, CAST(a.c AS INTEGER) AS cluster, round(a.own, 6) AS distance, round(s.score, 6) AS silhouette
    FROM a{rounds} a JOIN s USING (k) WHERE a.k = (SELECT k FROM s ORDER BY round(score, 9) DESC, k LIMIT 1)"""


@query("kmeans_best_k", _kmeans_sql("km", [3, 4, 5], 6), "vectors")
def _(t):
    assigned, best, scores, _centres = cluster.kmeans_best_k(t.vectors(), 3, 6, max_iter=6, seed="km", init="draw")
    return assigned.select("id", F.lit(best).alias("k"), "cluster", r6("distance"), F.lit(round(scores[best], 6)).alias("silhouette"))


@query("silhouette_simplified", """WITH c AS (SELECT label, list(m ORDER BY i) AS centre FROM (SELECT label, i, avg(x) AS m
        FROM (SELECT label, unnest(vector) AS x, generate_subscripts(vector, 1) AS i FROM vectors) GROUP BY label, i) GROUP BY label),
    d AS (SELECT id, v.label, min(list_distance(vector, centre)) FILTER (c.label = v.label) AS own,
        min(list_distance(vector, centre)) FILTER (c.label <> v.label) AS other FROM vectors v, c GROUP BY id, v.label)
    SELECT id, CAST(label AS INTEGER) AS cluster, round(own, 6) AS own, round(other, 6) AS nearest_other,
        round((other - own) / greatest(own, other), 6) AS silhouette FROM d""", "vectors")
def _(t):
    points = t.table("embeddings").select(F.col("vec_id").cast("string").alias("id"), F.col("label").alias("cluster"),
                                          F.col("embedding").cast("array<double>").alias("vector"))
    # One mean vector per label: as many rows as clusters, like a fitted model's centres.
    means = points.select("cluster", F.posexplode("vector").alias("i", "x")).groupBy("cluster", "i").agg(F.avg("x").alias("m"))
    centres = (means.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("c"))
               .select("cluster", F.transform("c", lambda e: e["m"]).alias("centre")))
    shaped = cluster.silhouette(points, centres)
    return shaped.select("id", "cluster", r6("own"), r6("nearest_other"), r6("silhouette"))


@query("sample_k_per_key", f"""SELECT user_id, event_id FROM track QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {draw('k', 'user_id', 'event_id')}, event_id) <= 5""", "track")
def _(t):
    return sampling.sample_k_per_key(t.track().select("user_id", "event_id"), ["user_id"], "event_id", 5, "k")


@query("weighted_sample", f"""WITH w AS (SELECT src, CAST(unnest(generate_series(1, 5)) AS INTEGER) AS draw FROM (SELECT DISTINCT src FROM both_ways)),
    u AS (SELECT src, draw, {u01('draws', 'src', 'draw')} AS u FROM w)
    SELECT u.src, u.draw, x.dst FROM u JOIN intervals x ON u.src = x.src AND u.u >= x.low AND u.u < x.high""", "intervals")
def _(t):
    edges = graph.merged_edges(graph.edges_of(t.edges()), directed=False)
    return sampling.weighted_draws(edges, 5, "draws")


@query("hash_sample", f"SELECT event_id, user_id FROM track WHERE {u01('tenth', 'event_id')} < 0.1", "track")
def _(t):
    return sampling.hash_sample(t.track(), 0.1, "tenth", "event_id").select("event_id", "user_id")
