"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..functions import dates, nested, numeric, sql as sql_functions, text
from .base import joined, query, r6
from .sqltext import define, draw, wilson_sql


@query("fn_round_step", "SELECT c_custkey, floor(c_acctbal * 100 + 0.5) / 100 AS cents, floor(c_acctbal * 4 + 0.5) / 4 AS quarters FROM customer")
def _(t):
    return t.table("customer").select("c_custkey", numeric.round_step("c_acctbal").alias("cents"), numeric.round_step("c_acctbal", 4).alias("quarters"))


@query("fn_safe_ratio", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN l_discount = 0 THEN 0 ELSE l_tax / l_discount END, 6) AS safe,
    round(l_tax / nullif(l_discount, 0), 6) AS plain FROM lineitem""")
def _(t):
    return t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6(numeric.safe_ratio("l_tax", "l_discount"), "safe"),
                                      r6(numeric.ratio("l_tax", "l_discount"), "plain"))


@query("fn_wilson", f"""SELECT keyword, clicks, n, round({wilson_sql('clicks', 'n')}, 6) AS score FROM (SELECT keyword,
    count(*) FILTER (action = 'item_click') AS clicks, count(*) FILTER (action IN ('item_click', 'item_exposure')) AS n FROM track GROUP BY keyword, date)""", "track")
def _(t):
    seen = F.col("action").isin("item_click", "item_exposure")
    counts = t.track().groupBy("keyword", "date").agg(F.count_if(F.col("action") == "item_click").alias("clicks"), F.count_if(seen).alias("n"))
    return counts.select("keyword", "clicks", "n", r6(numeric.wilson("clicks", "n"), "score"))


define("vector_pairs", "", """SELECT a.vec_id, CAST(a.embedding AS DOUBLE[]) AS x, CAST(b.embedding AS DOUBLE[]) AS y
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")


def _vector_pairs(t):
    vec = t.table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return vec.join(vec.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y")), "vec_id")


@query("fn_euclidean", "SELECT vec_id, round(list_distance(x, y), 6) AS distance FROM vector_pairs", "vector_pairs")
def _(t):
    return _vector_pairs(t).select("vec_id", r6(numeric.euclidean("x", "y"), "distance"))


@query("fn_cosine", "SELECT vec_id, round(list_cosine_similarity(x, y), 6) AS similarity, 0.0::DOUBLE AS with_zero FROM vector_pairs", "vector_pairs")
def _(t):
    zeros = F.transform("y", lambda v: F.lit(0.0))
    return _vector_pairs(t).select("vec_id", r6(numeric.cosine("x", "y"), "similarity"), r6(numeric.cosine(F.col("x"), zeros), "with_zero"))


@query("fn_hash_bucket", f"SELECT CAST({draw('bucket', 'c_name')} % 16 AS INTEGER) AS bucket, count(*) AS n FROM customer GROUP BY 1")
def _(t):
    return t.table("customer").groupBy(numeric.hash_bucket("c_name", 16).alias("bucket")).agg(F.count("*").alias("n"))


@query("fn_md5_hex", """SELECT c_custkey, md5(c_name) AS digest, regexp_full_match(md5(c_name), '[0-9a-fA-F]+') AS digest_is_hex,
    regexp_full_match(c_name, '[0-9a-fA-F]+') AS name_is_hex FROM customer""")
def _(t):
    return t.table("customer").select("c_custkey", F.md5("c_name").alias("digest"), text.is_hex(F.md5("c_name")).alias("digest_is_hex"),
                                      text.is_hex("c_name").alias("name_is_hex"))


@query("fn_salted_key", """SELECT c_custkey, substr(sha1(k), 1, 2) || ':' || k AS key FROM (SELECT c_custkey,
    concat_ws('.', 'app', CASE WHEN c_nationkey > 9 THEN 'N' || c_nationkey END, 'user', c_custkey) AS k FROM customer)""")
def _(t):
    country = F.when(F.col("c_nationkey") > 9, F.concat(F.lit("N"), "c_nationkey")).otherwise(" ")
    return t.table("customer").select("c_custkey", text.salted_key(F.lit("app"), country, F.lit("user"), F.col("c_custkey").cast("string")).alias("key"))


@query("fn_multi_split", r"""SELECT page_id, array_to_string(list_sort(list_distinct(string_split_regex(url, '://|/|\.|\?'))), ',') AS parts FROM pages""")
def _(t):
    return t.table("pages").select("page_id", joined(text.multi_split("url", ["://", "/", r"\.", r"\?"]), "parts"))


define("name_pairs", "", """SELECT a.p_partkey, a.p_name || ' ' || a.p_brand AS x, b.p_name || ' ' || b.p_brand AS y
    FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1""")


def _name_pairs(t):
    name = t.table("part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("x"))
    return name.join(name.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("x").alias("y")), "p_partkey")


@query("fn_levenshtein", """SELECT p_partkey, CAST(levenshtein(x, y) AS INTEGER) AS distance, round(levenshtein(x, y) / length(x), 6) AS share FROM name_pairs""",
       "name_pairs")
def _(t):
    return _name_pairs(t).select("p_partkey", F.levenshtein("x", "y").alias("distance"), r6(text.levenshtein_share("x", "y"), "share"))


@query("fn_ngram_jaccard", """WITH s AS (SELECT p_partkey, replace(lower(x), ' ', '') AS x, replace(lower(y), ' ', '') AS y FROM name_pairs),
    g AS (SELECT p_partkey, list_distinct(list_transform(range(1, length(x)), lambda i: substr(x, i, 2))) AS gx,
        list_distinct(list_transform(range(1, length(y)), lambda i: substr(y, i, 2))) AS gy FROM s)
    SELECT p_partkey, round(len(list_intersect(gx, gy)) / len(list_distinct(list_concat(gx, gy))), 6) AS similarity, 0.0::DOUBLE AS too_short FROM g""", "name_pairs")
def _(t):
    return _name_pairs(t).select("p_partkey", r6(text.ngram_jaccard("x", "y", 2), "similarity"),
                                 r6(text.ngram_jaccard(F.lit("ab"), F.lit("c"), 3), "too_short"))


@query("fn_date_shift", """SELECT event_id, strftime(ts - INTERVAL 1 DAY, '%Y%m%d') AS yesterday, strftime(ts + INTERVAL 1 DAY, '%Y%m%d') AS tomorrow,
    strftime(ts - INTERVAL 30 DAY, '%Y%m%d') AS month_before FROM events""")
def _(t):
    day = F.date_format("ts", "yyyyMMdd")
    return t.table("events").select("event_id", dates.shift(day, -1).alias("yesterday"), dates.shift(day, 1).alias("tomorrow"),
                                    dates.shift(day, -30).alias("month_before"))


@query("fn_date_gap", """SELECT o_orderkey, CAST(date_diff('day', o_orderdate, DATE '1998-06-01') AS INTEGER) AS gap,
    CAST(abs(date_diff('day', o_orderdate, DATE '1998-06-01')) AS INTEGER) AS absolute,
    CAST(abs(date_diff('day', o_orderdate, DATE '1998-06-01')) + 1 AS INTEGER) AS inclusive FROM orders""")
def _(t):
    gap = dates.gap(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("19980601"))
    return t.table("orders").select("o_orderkey", gap.alias("gap"), F.abs(gap).alias("absolute"), (F.abs(gap) + 1).alias("inclusive"))


@query("fn_date_sequence", """SELECT event_id, strftime(unnest(generate_series(CAST(ts AS DATE)::TIMESTAMP, CAST(ts AS DATE) + INTERVAL 2 DAY, INTERVAL 1 DAY)), '%Y%m%d') AS up,
    strftime(unnest(generate_series(CAST(ts AS DATE)::TIMESTAMP, CAST(ts AS DATE) - INTERVAL 2 DAY, INTERVAL (-1) DAY)), '%Y%m%d') AS down FROM events""")
def _(t):
    day = F.date_format("ts", "yyyyMMdd")
    both = F.arrays_zip(dates.sequence_up(day, dates.shift(day, 2)).alias("up"), dates.sequence_down(day, 2).alias("down"))
    return t.table("events").select("event_id", F.explode(both).alias("d")).select("event_id", "d.up", "d.down")


@query("fn_time_bucket", """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
    CAST(hour(ts) * 4 + minute(ts) // 15 AS INTEGER) AS bucket FROM events""")
def _(t):
    ms = dates.ntz_ms("ts")
    return t.table("events").select("event_id", dates.hour_of(ms).alias("hour"), dates.minute_of(ms).alias("minute"), dates.quarter_of_day(ms).alias("bucket"))


@query("fn_ts_format", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%Y%m%d') AS day,
    epoch_ms(date_trunc('day', ts)::TIMESTAMP) AS day_start, epoch_ms(date_trunc('second', ts)) AS second_ms FROM events""")
def _(t):
    ms = dates.ntz_ms("ts")
    return t.table("events").select("event_id", dates.stamp_of(ms).alias("stamp"), dates.day_of(ms).alias("day"),
                                    dates.day_start_ms(dates.day_of(ms)).alias("day_start"),
                                    dates.stamp_to_ms(F.date_format("ts", "yyyyMMddHHmmss")).alias("second_ms"))


@query("fn_iso_dow", "SELECT o_orderkey, CAST(isodow(o_orderdate) AS DOUBLE) AS weekday FROM orders")
def _(t):
    return t.table("orders").select("o_orderkey", dates.iso_weekday(F.date_format("o_orderdate", "yyyyMMdd")).alias("weekday"))


@query("fn_date_path", """SELECT o_orderkey, strftime(o_orderdate, '/year=%Y/month=%m/day=%d') AS path, strftime(o_orderdate, '%Y-%m-%d') AS dashed FROM orders""")
def _(t):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return t.table("orders").select("o_orderkey", dates.path_of(day).alias("path"), dates.dashed(day).alias("dashed"))


@query("fn_level_split", """SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_filter(string_split(o_orderstatus || ',' || substr(o_orderpriority, 3), ''),
    lambda x: x <> ',' AND x <> ''))), ',') AS letters FROM orders""")
def _(t):
    levels = F.concat_ws(",", "o_orderstatus", F.expr("substr(o_orderpriority, 3)"))
    return t.table("orders").select("o_orderkey", joined(text.level_set(levels), "letters"))


@query("fn_region_partition", """SELECT region, count(*) AS n FROM (SELECT CAST((strpos('0123456789abcdefghijklmnopqrstuvwxyz', substr(md5(c_name), 1, 1)) - 1) * 36
    + strpos('0123456789abcdefghijklmnopqrstuvwxyz', substr(md5(c_name), 2, 1)) - 1 AS INTEGER) AS region FROM customer) GROUP BY region""")
def _(t):
    from ..operators.sets import place_by_region

    # Every row sits in the partition its key names; the partition id shows it.
    placed = place_by_region(t.table("customer").select(F.md5("c_name").alias("key")), "key")
    return placed.groupBy(F.spark_partition_id().alias("region")).agg(F.count("*").alias("n"))


@query("fn_array_union", """SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat([lang, source], CASE WHEN n_chars > 500 THEN [lang, 'long'] ELSE [] END))), ',') AS members
    FROM documents""")
def _(t):
    longer = F.when(F.col("n_chars") > 500, F.array("lang", F.lit("long")))
    return t.table("documents").select("doc_id", joined(nested.union_of(F.array("lang", "source"), longer), "members"))


@query("fn_map_ops", """SELECT user_id, action, n FROM (SELECT user_id, action, count(*) AS n FROM track GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, action) <= 2""", "track")
def _(t):
    counts = t.track().groupBy("user_id", "action").agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "action", "n")))
    entries = F.transform(ordered, lambda e: F.struct(e["action"], e["n"]))
    maps = counts.groupBy("user_id").agg(entries.alias("e")).select("user_id", nested.top_map("e", 2).alias("m"))
    return maps.select("user_id", F.explode("m").alias("action", "n"))


@query("fn_json_parse", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.k') AS k_text, 'none' AS absent,
    1 AS entries, props AS source, '{"k":' || json_extract_string(props, '$.k') || '}' AS written FROM events""")
def _(t):
    parsed = F.from_json("props", "k int")
    return t.table("events").select(
        "event_id", parsed["k"].alias("k"), nested.json_text("props", "$.k").alias("k_text"), nested.json_text("props", "$.missing", "none").alias("absent"),
        F.size(nested.json_map("props", T.LongType())).alias("entries"), F.col("props").alias("source"), F.to_json(parsed).alias("written"))


@query("user_action_sequences", """WITH f AS (SELECT user_id, t.item_id, category_id, action, min(time_ms) AS time_ms FROM track t JOIN latest l ON t.item_id = l.item_id
        WHERE action IN ('download_install', 'install', 'item_click') GROUP BY ALL)
    SELECT user_id, CASE WHEN category_id >= 100 THEN 'game' ELSE 'app' END AS kind,
        coalesce(string_agg(item_id || '&' || time_ms, ',' ORDER BY time_ms, item_id) FILTER (action IN ('download_install', 'install')), '') AS download_seq,
        coalesce(string_agg(item_id || '&' || time_ms, ',' ORDER BY time_ms, item_id) FILTER (action = 'item_click'), '') AS play_seq
    FROM f WHERE category_id > 0 GROUP BY 1, 2""", "track latest")
def _(t):
    from ..operators.profiles import action_sequences

    return action_sequences(t.track(), t.latest_catalog(), ["download_install", "install"], ["item_click"])


@query("sql_functions", f"""SELECT c_custkey, round(floor(c_acctbal * 10 + 0.5) / 10, 6) AS step, round({wilson_sql('c_nationkey', '25')}, 6) AS score,
    round(c_acctbal / 4, 6) AS share FROM customer""")
def _(t):
    sql_functions.register(t.spark)
    return t.table("customer").select(
        "c_custkey", r6(F.expr("shoal_round_step(c_acctbal, 10)"), "step"), r6(F.expr("shoal_wilson(CAST(c_nationkey AS DOUBLE), 25D)"), "score"),
        r6(F.expr("shoal_safe_ratio(c_acctbal, 4D)"), "share"))
