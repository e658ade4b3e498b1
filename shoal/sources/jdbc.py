"""JDBC reads. Credentials come from the caller, never from code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str, password: str, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None, partitions: int = 1,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a JDBC scan; with a partition column the scan is split into ranges."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
