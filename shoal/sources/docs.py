"""JSON-lines documents ``{"id": …, "apps": {item: score}}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_doc_maps(spark: SparkSession, path: str, value_type: str = "double", key: str = "id", value: str = "apps",
                  deny: DataFrame | None = None, allow: DataFrame | None = None) -> DataFrame | None:
    """``id, apps`` with null scores dropped; None where the path is missing.

    The map type is given, so items do not become struct fields and no
    inference pass is needed. ``allow`` and ``deny`` hold ids in their first column.
    """
    if not path_exists(spark, path):
        return None
    docs = read_json(spark, path, f"`{key}` string, `{value}` map<string,{value_type}>")
    if deny is not None:
        docs = docs.join(deny.select(F.col(deny.columns[0]).alias(key)), key, "left_anti")
    if allow is not None:
        docs = docs.join(allow.select(F.col(allow.columns[0]).alias(key)), key, "left_semi")
    return docs.select(F.col(key).alias("id"), F.map_filter(value, lambda k, v: v.isNotNull()).alias("apps"))


def long_form(docs: DataFrame) -> DataFrame:
    """``id, item, score`` rows of doc maps."""
    return docs.select("id", F.explode("apps").alias("item", "score"))


def to_docs(lists: DataFrame, key: str = "id", item: str = "item", score: str = "score") -> DataFrame:
    """Doc maps from long rows already cut to a top-N per id."""
    return lists.groupBy(F.col(key).alias("id")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(item).cast("string"), F.col(score)))).alias("apps"))
