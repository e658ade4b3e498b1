"""Adapters from the test tables to the input shapes the operators expect (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import dates
from ..functions.nested import json_text

# The as-of date, and the two catalog snapshots.
AS_OF = "20240131"
OLD_SNAPSHOT, NEW_SNAPSHOT = "20240129", "20240130"


def brand_number(c: str = "p_brand") -> Column:
    return F.regexp_extract(c, "([0-9]+)$", 1).cast("int")


class Tables:
    """The tables of one folder and the frames derived from them. Nothing is cached or filtered down."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def regions(self) -> DataFrame:
        """``locale, cluster``"""
        return (self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .select("n_nationkey", F.col("n_name").alias("locale"), F.col("r_name").alias("cluster")))

    def ratings(self) -> DataFrame:
        """``user_id, item_id, score``: ordered quantity per customer and part."""
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        return (orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey", "l_partkey")
                .agg(F.sum("l_quantity").alias("score"))
                .select(F.col("o_custkey").cast("string").alias("user_id"), F.col("l_partkey").cast("string").alias("item_id"), "score"))

    def track(self) -> DataFrame:
        """Behaviour log; every column is a function of one event."""
        e = F.col("event_id")

        def choose(n: int, *values: str | None) -> Column:
            return F.get(F.array(*[F.lit(v) for v in values]), (e % n).cast("int"))

        kind = F.col("event_type")
        action = (F.when(kind == "view", "item_exposure").when(kind == "click", "item_click")
                  .when(kind == "purchase", "download_install").when(kind == "error", "uninstall")
                  .when(e % 2 == 0, "install").otherwise("activate"))
        day = F.date_format("ts", "yyyyMMdd")
        exp_day = F.when(e % 11 == 0, dates.shift(day, -1)).otherwise(day)
        packed = F.concat(F.when(e % 9 == 0, "p;").otherwise(""), exp_day, F.lit("_a_b_c_d_x@y@z@"),
                          (e % 4).cast("string"), F.when(e % 3 == 0, "，").otherwise(","), (e % 5).cast("string"), F.lit("#t"))
        base = self.table("events").select(
            "event_id", F.col("user_id").cast("string").alias("user_id"), F.col("user_id").alias("user_number"),
            json_text("props", "$.k").cast("long").alias("item_id"), action.alias("action"), day.alias("date"),
            dates.ntz_ms("ts").alias("time_ms"), F.hour("ts").alias("hour"), "value",
            choose(3, "recommend", "app_detail", "search").alias("page"),
            choose(2, "recommend", "search").alias("pre_page"),
            F.when(e % 7 < 5, "recApps").otherwise("banner").alias("card_type"),
            F.when(e % 4 < 3, "recApps").otherwise("banner").alias("pre_card_type"),
            F.when(e % 5 < 3, "download_request").otherwise("install_success").alias("install_status"),
            choose(4, "system_install", "manual_install", "manual_install", "auto_install").alias("install_type"),
            choose(6, "home", "push", "", None, "update", "DELIVERY_feed").alias("launch_ref"),
            F.when(e % 5 == 0, "miniCard").otherwise("other").alias("page_ref"),
            choose(2, "minicard", "main").alias("first_page"),
            choose(4, "home", "ads", "cleaner", "browser").alias("launch_pkg"),
            F.concat(F.lit("kw"), (F.floor("value") % 40).cast("string")).alias("keyword"),
            F.when(e % 13 != 0, packed).alias("packed"))
        return (base.withColumn("card_pos", (F.col("item_id") % 6).cast("int"))
                .join(self.regions(), F.col("user_number") % 25 == F.col("n_nationkey"))
                .drop("user_number", "n_nationkey"))

    def catalog(self) -> DataFrame:
        """Two dated snapshots of the item catalog."""
        size = F.col("p_size")
        level = (F.when(size <= 10, "S").when(size <= 20, "A").when(size <= 30, "B").when(size <= 40, "C").otherwise("D"))
        base = (self.table("part").withColumn("brand", brand_number())
                .join(self.regions(), F.col("p_partkey") % 25 == F.col("n_nationkey")))
        snapshots = F.array(F.lit(OLD_SNAPSHOT), F.lit(NEW_SNAPSHOT))
        return (base.select("*", F.explode(snapshots).alias("date"))
                .where(~((F.col("date") == OLD_SNAPSHOT) & (F.col("p_partkey") % 11 == 0)))
                .select(
                    F.col("p_partkey").alias("item_id"),
                    F.concat_ws(" ", "p_name", "brand").alias("displayname"), level.alias("level"),
                    (F.col("brand") + F.when(F.col("p_partkey") % 3 == 0, 100).otherwise(0)).alias("category_id"),
                    F.col("brand").cast("long").alias("developer_id"), F.col("p_type").alias("publisher"),
                    (size / 10).alias("gp_score"), (F.col("brand") / 5).alias("display_score"),
                    F.concat(F.lit('["'), size.cast("string"), F.lit('","'), F.col("brand").cast("string"), F.lit('"]')).alias("tagids"),
                    F.concat(F.lit("AppStore/"), F.col("p_partkey").cast("string"),
                             F.when((F.col("p_partkey") % 10 == 0) & (F.col("date") == NEW_SNAPSHOT), "-new").otherwise("")).alias("icon"),
                    "locale", "cluster", "date", size.alias("audit_tag")))

    def latest_catalog(self) -> DataFrame:
        """The newest snapshot up to the as-of date."""
        from ..sources.dated import read_latest

        return read_latest(self.catalog(), AS_OF)

    def vectors(self) -> DataFrame:
        """``id, vector``"""
        from ..operators.neighbours import vectors_of

        return vectors_of(self.table("embeddings"), "vec_id", "embedding")

    def texts(self) -> DataFrame:
        """``id, words`` of every document, whole."""
        from ..functions.text import words

        return self.table("documents").select(F.col("doc_id").cast("string").alias("id"), words("text").alias("words"))

    def edges(self) -> DataFrame:
        """Bipartite ``src, dst, weight``: customers (u…) to parts (i…)."""
        return self.ratings().select(F.concat(F.lit("u"), "user_id").alias("src"), F.concat(F.lit("i"), "item_id").alias("dst"),
                                     F.col("score").alias("weight"))

    def push_log(self) -> DataFrame:
        """Push callbacks with a packed parameter and an array of reached items."""
        from ..functions.dates import ntz_ms

        e = F.col("event_id")
        task = F.when(e % 3 == 0, "SH").when(e % 3 == 1, "BSOF").otherwise("BSPT")
        quarter = F.lpad((F.floor(F.minute("ts") / 15) * 15).cast("string"), 2, "0")
        param = F.concat(F.lit("a|b|"), task, F.lit("abcd"), F.date_format("ts", "yyyyMMddHH"), quarter, F.lit("00"))
        reached = F.struct(json_text("props", "$.k").alias("stock_id"),
                           F.when(F.col("event_type") == "click", "CLICK").otherwise("EXPOSE").alias("type"),
                           e.cast("string").alias("ext"), ntz_ms("ts").alias("reach_ms"))
        return self.table("events").select(
            F.col("user_id").cast("string").alias("device_id"), F.date_format("ts", "yyyyMMdd").alias("date"),
            F.to_json(F.struct(param.alias("param"))).alias("extra"), F.array(reached).alias("reach_items"))

    def recall_log(self) -> DataFrame:
        """One request per user, day, hour, slot and channel; ``message`` is a JSON list of items."""
        track = self.track().where(F.col("action") == "item_exposure")
        per_request = track.groupBy("user_id", "date", "hour", (F.col("event_id") % 3).cast("int").alias("slot"),
                                    F.concat(F.lit("q"), (F.col("item_id") % 3).cast("string")).alias("channel")).agg(
            F.to_json(F.array_sort(F.collect_set(F.col("item_id").cast("string")))).alias("message"))
        return per_request.select(
            "user_id", F.concat(F.lit("g"), F.col("slot").cast("string")).alias("mark"), "channel", "message",
            (dates.day_start_ms("date") + F.col("hour") * dates.HOUR_MS).alias("time_ms"), "slot", "date",
            F.lit("recall").alias("source"), F.lit("items").alias("app"), F.lit("prod").alias("environment"), F.lit("info").alias("level"))

    def push_users(self) -> DataFrame:
        """Per user: push clicks and click days in the 7 and 30 days before the as-of date."""
        clicks = self.track().where((F.col("action") == "item_click") & (F.col("date") < AS_OF))
        week, month = dates.day_shift(AS_OF, -7), dates.day_shift(AS_OF, -30)
        recent = clicks.where(F.col("date") >= month)
        return recent.groupBy("user_id").agg(
            F.count_if(F.col("date") >= week).alias("clicks_week"), F.count("*").alias("clicks_month"),
            F.count_distinct(F.when(F.col("date") >= week, F.col("date"))).alias("click_days_week"),
            F.count_distinct("date").alias("click_days_month"))

    def push_customers(self) -> DataFrame:
        """All customers as push users, with clicks from their columns; most of them never search."""
        clicks = F.col("c_nationkey").cast("long")
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("user_id"), (clicks % 5).alias("clicks_week"), clicks.alias("clicks_month"),
            (clicks % 5).alias("click_days_week"), clicks.alias("click_days_month"))

    def searches(self) -> DataFrame:
        """``user_id, time_ms, date`` of searches."""
        return self.track().where(F.col("action") == "item_exposure").select("user_id", "time_ms", "date")

    def allow_users(self) -> DataFrame:
        return self.table("customer").where(F.col("c_acctbal") > 9500).select(F.col("c_custkey").cast("string").alias("user_id"))

    def excluded_users(self) -> DataFrame:
        return self.table("customer").where(F.col("c_acctbal") < 500).select(F.col("c_custkey").cast("string").alias("user_id"))

    def denied_items(self) -> DataFrame:
        """Items whose audit tag bars them."""
        return self.latest_catalog().where(F.col("audit_tag").isin(7, 13)).select("item_id")
