"""Sources and sinks: dated reads, JSON docs, text rows, logs, partitions, merges."""

from __future__ import annotations

from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import functions as F

from ..functions import dates
from ..operators.topn import top_n
from ..session import scratch_path, stored
from ..sources import dated, docs, logs, sinks
from .base import joined, query, r6
from .inputs import AS_OF, NEW_SNAPSHOT, OLD_SNAPSHOT


@query("scan_date_range", """SELECT event_id, user_id, item_id, action, date FROM track
    WHERE date BETWEEN '20240105' AND '20240120'""", "track")
def _(t):
    rows = dated.read_between(t.spark, t.track(), "20240105", "20240120")
    return rows.select("event_id", "user_id", "item_id", "action", "date")


@query("scan_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(t):
    view = "shoal_scan_nation"
    t.table("nation").createOrReplaceTempView(view)
    return dated.read_table(t.spark, view)


@query("scan_parquet_days", """SELECT date, action, count(*) AS n, sum(item_id)::BIGINT AS item_sum FROM track
    WHERE date BETWEEN '20240110' AND '20240120' GROUP BY ALL""", "track")
def _(t):
    base = scratch_path(t.spark, "days")
    sinks.overwrite_partitions(t.track().select("event_id", "item_id", "action", "date"), base, ["date"])
    days = dated.read_trailing_days(t.spark, base, "20240120", 10)
    return days.groupBy("date", "action").agg(F.count("*").alias("n"), F.sum("item_id").alias("item_sum"))


@query("latest_partition", "SELECT max(date) AS date FROM catalog WHERE date <= '20240131'", "catalog")
def _(t):
    return dated.latest_partition(t.catalog(), AS_OF)


@query("read_latest_complete_folder", "SELECT event_id, action, date FROM track WHERE date = '20240119'", "track")
def _(t):
    """Folders of three days, the newest of them without its mark."""
    base, rows = scratch_path(t.spark, "folders"), t.track().select("event_id", "action", "date")
    for day, marked in (("20240118", True), ("20240119", True), ("20240120", False)):
        sinks.overwrite_partition(rows.where(F.col("date") == day).drop("date"), base, {"date": day}, marked)
    day = dated.latest_complete_day(t.spark, base, AS_OF)
    return dated.read_days(t.spark, base, day, day).select("event_id", "action", "date")


@contextmanager
def _databases(spark, *regions: str):
    """Databases of their own under the shared folder, gone at the end of the block."""
    names = {region: f"shoal_{region}_{uuid4().hex}" for region in regions}
    try:
        for name in names.values():
            spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'database')}'")
        yield names
    finally:
        for name in names.values():
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@query("read_region_table", """SELECT 'RU' AS locale, c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT 'ID', c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def _(t):
    customers = t.table("customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    with _databases(t.spark, "ru", "other") as names:
        for region, rows in (("ru", F.col("c_mktsegment") == "BUILDING"), ("other", F.col("c_mktsegment") != "BUILDING")):
            customers.where(rows).drop("c_mktsegment").write.saveAsTable(f"{names[region]}.customers", format="parquet")
        read = [dated.region_table(t.spark, "customers", locale, {"RU": names["ru"]}, names["other"])
                .select(F.lit(locale).alias("locale"), "c_custkey", "c_acctbal") for locale in ("RU", "ID")]
        return stored(read[0].unionByName(read[1]), "regions")


@query("append_existing_table", """SELECT event_id, action, date FROM track WHERE date <= '20240115'
    UNION ALL SELECT event_id, action, date FROM track WHERE date > '20240115'""", "track")
def _(t):
    """A table that exists, with its partitions, and two appends of which the second has its columns in another order."""
    rows = t.track().select("event_id", "action", "date")
    with _databases(t.spark, "append") as names:
        name = f"{names['append']}.log"
        t.spark.sql(f"CREATE TABLE {name} (event_id BIGINT, action STRING, date STRING) USING parquet PARTITIONED BY (date)")
        sinks.append_table(rows.where(F.col("date") <= "20240115"), name)
        sinks.append_table(rows.where(F.col("date") > "20240115").select("date", "action", "event_id"), name)
        return stored(t.spark.read.table(name), "appended")


@query("read_latest_snapshot", "SELECT item_id, displayname, level, category_id, date FROM latest", "latest")
def _(t):
    rows = t.catalog().select("item_id", "displayname", "level", "category_id", "date")
    with _databases(t.spark, "snapshots") as names:
        name = f"{names['snapshots']}.catalog"
        rows.repartition("date").write.partitionBy("date").saveAsTable(name, format="parquet")
        return stored(dated.read_latest_listed(t.spark, name, AS_OF).select(*rows.columns), "latest")


@query("read_latest_30d", """SELECT event_id, action, date FROM track
    WHERE date = (SELECT max(date) FROM track WHERE date BETWEEN '20231222' AND '20240121')""", "track")
def _(t):
    rows = t.track().select("event_id", "action", "date")
    with _databases(t.spark, "trailing") as names:
        name = f"{names['trailing']}.log"
        rows.repartition("date").write.partitionBy("date").saveAsTable(name, format="parquet")
        return stored(dated.read_latest_listed(t.spark, name, "20240121", 30).select(*rows.columns), "latest")


@query("scan_json", "SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events")
def _(t):
    path = scratch_path(t.spark, "json")
    sinks.write_json_lines(t.table("events").select("event_id", "user_id", "event_type", "value"), path)
    rows = docs.read_json(t.spark, path, "event_id long, user_id long, event_type string, value double")
    return rows.select("event_id", "user_id", "event_type", r6("value"))


_DOC_ITEMS = 1000


def _level_docs(t):
    """The best items of every level as docs of bounded size; items without a positive sum come last and carry null."""
    scores = t.track().groupBy("item_id").agg(F.sum(F.when(F.col("action") == "item_click", F.col("value"))).alias("score"))
    rows = t.latest_catalog().join(scores, "item_id").select(F.col("level").alias("list_id"), F.col("item_id").cast("string").alias("item"), "score")
    best = top_n(rows, ["list_id"], [F.round("score", 9).desc_nulls_last(), F.asc("item")], _DOC_ITEMS, rank=None)
    return docs.to_docs(best, "list_id")


_DOC_SQL = f"""SELECT id, item, round(score, 6) AS score FROM (SELECT level AS id, CAST(item_id AS VARCHAR) AS item, score FROM latest
    JOIN (SELECT item_id, sum(value) FILTER (action = 'item_click') AS score FROM track GROUP BY item_id) USING (item_id)
    QUALIFY row_number() OVER (PARTITION BY level ORDER BY round(score, 9) DESC NULLS LAST, CAST(item_id AS VARCHAR)) <= {_DOC_ITEMS}) WHERE score IS NOT NULL"""


@query("doc_map_read", _DOC_SQL + " AND id IN ('S', 'A', 'B') AND id <> 'B'", "latest track")
def _(t):
    path = scratch_path(t.spark, "docs")
    sinks.write_json_lines(_level_docs(t), path)
    allow = t.spark.createDataFrame([("S",), ("A",), ("B",)], "id string")
    deny = t.spark.createDataFrame([("B",)], "id string")
    return docs.long_form(docs.read_doc_maps(t.spark, path, deny=deny, allow=allow)).select("id", "item", r6("score"))


@query("doc_map_roundtrip", _DOC_SQL, "latest track")
def _(t):
    path = scratch_path(t.spark, "docs")
    sinks.write_json_lines(_level_docs(t), path)
    return docs.long_form(docs.read_doc_maps(t.spark, path)).select("id", "item", r6("score"))


@query("scan_text_fields", """SELECT CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_partkey AS VARCHAR) AS part_key, l_returnflag AS flag
    FROM lineitem WHERE l_returnflag <> 'R'""")
def _(t):
    path = scratch_path(t.spark, "text")
    # Lines of returned items lack the flag and so have two fields only.
    line = F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), F.nullif("l_returnflag", F.lit("R")))
    t.table("lineitem").select(line.alias("value")).write.text(path)
    return logs.read_fields(t.spark, path, ["order_key", "part_key", "flag"])


@query("recall_log_channels", """SELECT user_id, mark, item_id, time_ms, string_agg(channel, ',' ORDER BY channel) AS channels
    FROM recall_hits WHERE slot IN (1, 2) AND contains(mark, 'g2') GROUP BY user_id, mark, item_id, time_ms
    HAVING count(*) = 1 AND max(channel) = 'q1'""", "recall_hits")
def _(t):
    hits = logs.recall_channels(t.recall_log(), [1, 2], group="g2", only_channel="q1")
    return hits.select("user_id", "mark", "item_id", "time_ms", joined("channels", "channels"))


@query("sink_partition_roundtrip", """SELECT date, count(*) AS n, round(sum(CASE WHEN date = '20240110' THEN 2 * value ELSE value END), 6) AS total
    FROM track GROUP BY date""", "track")
def _(t):
    spark, base, table = t.spark, scratch_path(t.spark, "track"), "shoal_sink_check"
    rows = t.track().select("event_id", "value", "date")
    sinks.overwrite_partitions(rows, base, ["date"])
    # Replace one partition only, dynamically in one write and again as a static folder.
    changed = rows.where(F.col("date") == "20240110").withColumn("value", F.col("value") * 2)
    sinks.overwrite_partitions(changed, base, ["date"])
    sinks.overwrite_partition(changed.drop("date"), base, {"date": "20240110"})
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} (event_id BIGINT, value DOUBLE, date STRING) USING parquet PARTITIONED BY (date) LOCATION '{base}'")
    sinks.add_partition(spark, table, {"date": "20240110"})
    spark.sql(f"DROP TABLE {table}")
    back = dated.read_days(spark, base, "20240101", AS_OF)
    return back.groupBy("date").agg(F.count("*").alias("n"), r6(F.sum("value"), "total"))


@query("push_log_quarter", """SELECT log_date AS date, user_id, type, task_id, item_id,
    strftime(make_timestamp(reach_ms * 1000), '%Y-%m-%d %H:%M:%S') AS reach_time,
    CAST((reach_ms // 3600000) % 24 AS INTEGER) AS reach_hour,
    CAST(((reach_ms // 60000) % 60 // 15 + 1) * 15 AS INTEGER) AS quarter FROM push_log""", "push_log")
def _(t):
    reach = F.col("reach_ms")
    rows = logs.push_events(t.push_log()).select(
        F.col("log_date").alias("date"), "user_id", "type", "task_id", "item_id", dates.stamp_of(reach).alias("reach_time"),
        dates.hour_of(reach).alias("reach_hour"), ((F.floor(dates.minute_of(reach) / 15) + 1) * 15).cast("int").alias("quarter"))
    path = scratch_path(t.spark, "push")
    rows.write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


@query("upsert_reject_rate", """SELECT count(*) FILTER (c_acctbal >= -900) AS accepted, count(*) FILTER (c_acctbal < -900) AS rejected
    FROM customer""")
def _(t):
    return sinks.gate_reject_rate(t.table("customer").select((F.col("c_acctbal") >= -900).alias("ok")))


@query("upsert_newest_wins", """SELECT item_id, icon FROM catalog WHERE date = '20240130'
    UNION ALL SELECT item_id, icon FROM catalog WHERE date = '20240129'
    AND item_id NOT IN (SELECT item_id FROM catalog WHERE date = '20240130')""", "catalog")
def _(t):
    icons = t.catalog().select("item_id", "icon", "date")
    old, new = icons.where(F.col("date") == OLD_SNAPSHOT).drop("date"), icons.where(F.col("date") == NEW_SNAPSHOT).drop("date")
    return sinks.upsert(old, new, ["item_id"])


@query("refresh_keep_scores", """SELECT n.item_id, n.icon, n.level, round(o.gp_score, 6) AS gp_score, round(o.display_score, 6) AS display_score
    FROM (SELECT * FROM catalog WHERE date = '20240130') n LEFT JOIN (SELECT * FROM catalog WHERE date = '20240129') o USING (item_id)""",
       "catalog")
def _(t):
    catalog = t.catalog().withColumn("gp_score", F.round("gp_score", 6)).withColumn("display_score", F.round("display_score", 6))
    target = catalog.where(F.col("date") == OLD_SNAPSHOT).select("item_id", "icon", "level", "gp_score", "display_score")
    new = catalog.where(F.col("date") == NEW_SNAPSHOT).select("item_id", "icon", "level", "gp_score", "display_score")
    return sinks.refresh_keeping(new, target, "item_id", ["gp_score", "display_score"])
