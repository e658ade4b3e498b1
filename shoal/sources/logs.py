"""Text rows, recall logs, push logs and packed tracking fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.nested import json_list
from ..functions.numeric import as_col

# Layout of a push parameter, ``a|b|<task><4 chars><yyyyMMddHHmmss>``.
PUSH_FIELD = 2
PUSH_TAIL = 18

# Separators of the packed experiment field.
EXPERIMENT_PART = 5
EXPERIMENT_GROUP = 3
EXPERIMENT_SPLIT = ",|，"


def split_rows(df: DataFrame, names: list[str], sep: str = ",", column: str = "value") -> DataFrame:
    """Fields of delimited lines; lines with another number of fields go."""
    parts = F.split(F.col(column), sep)
    return (df.select(parts.alias("parts")).where(F.size("parts") == len(names))
            .select(*[F.col("parts")[i].alias(n) for i, n in enumerate(names)]))


def read_fields(spark: SparkSession, path: str, names: list[str], sep: str = ",") -> DataFrame:
    return split_rows(spark.read.text(path), names, sep)


def recall_channels(log: DataFrame, slots: list[int], group: str | None = None, only_channel: str | None = None,
                    source: str = "recall", app: str = "items", environment: str = "prod",
                    level: str = "info") -> DataFrame:
    """Channels that returned an item, per user, group, item and request time.

    ``message`` is a JSON list of items. With ``only_channel`` the items that
    came through exactly that one channel are kept.
    """
    hits = (log.where((F.col("source") == source) & (F.col("app") == app)
                      & (F.col("environment") == environment) & (F.col("level") == level)
                      & F.col("slot").isin(slots))
            .select("user_id", "mark", "channel", F.col("time_ms"), F.explode(json_list("message")).alias("item_id")))
    if group is not None:
        hits = hits.where(F.col("mark").contains(group))
    per_request = hits.groupBy("user_id", "mark", "item_id", "time_ms").agg(
        F.array_sort(F.collect_list("channel")).alias("channels"))
    if only_channel is not None:
        per_request = per_request.where((F.size("channels") == 1) & (F.col("channels")[0] == only_channel))
    return per_request


def push_payload(extra) -> dict[str, Column]:
    """Task, date, hour and minute packed in ``$.param`` of a push log's ``extra``."""
    param = F.get(F.split(F.get_json_object(as_col(extra), "$.param"), "\\|"), PUSH_FIELD)
    return {
        "push_date": F.substring(param, -14, 8),
        "push_hour": F.substring(param, -6, 2),
        "push_minute": F.substring(param, -4, 2),
        "task_id": F.substr(param, F.lit(1), F.length(param) - PUSH_TAIL),
    }


def push_events(log: DataFrame) -> DataFrame:
    """First reached item of every push callback with its parsed payload."""
    first = F.get(F.col("reach_items"), 0)
    parsed = log.select(
        F.col("device_id").alias("user_id"), F.col("date").alias("log_date"),
        first["stock_id"].alias("item_id"), first["type"].alias("type"), first["ext"].alias("push_id"),
        first["reach_ms"].alias("reach_ms"), *[c.alias(n) for n, c in push_payload("extra").items()])
    present = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    return parsed.where(F.col("type").isin("CLICK", "EXPOSE") & present("user_id") & present("item_id"))


def experiment_fields(packed) -> dict[str, Column]:
    """Date and experiment ids of a packed tracking field.

    ``[x;]date_…_…_…_…_a@b@c@id,id#…``; missing parts give null.
    """
    parts = F.split(as_col(packed), "_")
    head = F.get(parts, 0)
    group = F.get(F.split(F.get(parts, EXPERIMENT_PART), "@"), EXPERIMENT_GROUP)
    ids = F.split(F.get(F.split(group, "#"), 0), EXPERIMENT_SPLIT)
    return {
        "exp_date": F.when(head.contains(";"), F.get(F.split(head, ";"), 1)).otherwise(head),
        "model_ids": ids,
    }
