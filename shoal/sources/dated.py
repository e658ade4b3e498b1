"""Dated tables and folders: ranges, latest partition, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import day_shift, day_span


def _frame(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    return spark.read.table(table) if isinstance(table, str) else table


def table_name(name: str, database: str | None = None, catalog: str | None = None) -> str:
    return ".".join(part for part in (catalog, database, name) if part)


def read_table(spark: SparkSession, name: str, database: str | None = None, catalog: str | None = None) -> DataFrame:
    return spark.read.table(table_name(name, database, catalog))


def read_between(spark: SparkSession, table: str | DataFrame, start: str, end: str, column: str = "date") -> DataFrame:
    """Rows of a dated table from start to end, both included; prunes partitions."""
    return _frame(spark, table).where(F.col(column).between(start, end))


def region_table(spark: SparkSession, name: str, locale: str, databases: dict[str, str],
                 default_database: str, catalog_of: dict[str, str] | None = None) -> DataFrame:
    """Read a table whose database (and catalog) depend on the region."""
    return read_table(spark, name, databases.get(locale, default_database), (catalog_of or {}).get(locale))


def read_days(spark: SparkSession, base: str, start: str, end: str, column: str = "date") -> DataFrame:
    """Parquet under ``base/date=yyyyMMdd`` between two days; missing days are skipped.

    One partition-discovered read with a partition filter: only the matching
    folders are listed into the scan, and their schema is read once.
    """
    frame = spark.read.option("basePath", base).parquet(base)
    return frame.withColumn(column, F.col(column).cast("string")).where(F.col(column).between(start, end))


def read_trailing_days(spark: SparkSession, base: str, end: str, days: int, column: str = "date") -> DataFrame:
    return read_days(spark, base, day_shift(end, -days), end, column)


def latest_complete_day(spark: SparkSession, base: str, end: str, lookback: int = 30, column: str = "date") -> str | None:
    """Newest dated folder up to ``end`` that carries a ``_SUCCESS`` mark."""
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for day in reversed(day_span(day_shift(end, -lookback), end)):
        marker = path_class(f"{base}/{column}={day}/_SUCCESS")
        if marker.getFileSystem(conf).exists(marker):
            return day
    return None


def partitions_of(spark: SparkSession, table: str, column: str = "date") -> DataFrame:
    """``column``: the partitions of a catalog table, from the catalog alone; no file is listed or read.

    For formats that keep their partitions as a table beside their rows (``name.partitions``), that is asked instead.
    """
    provider = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'").first()
    if provider is not None and provider["data_type"].lower() == "iceberg":
        listed = spark.read.table(f"{table}.partitions").select(F.col(f"partition.{column}").cast("string").alias(column))
    else:
        spec = F.regexp_extract("partition", rf"(?:^|/){column}=([^/]*)", 1)
        listed = spark.sql(f"SHOW PARTITIONS {table}").select(spec.alias(column))
    return listed.where(F.col(column) != "").distinct()


def latest_listed(spark: SparkSession, table: str, end: str, lookback: int | None = None, column: str = "date") -> str | None:
    """The newest partition up to ``end``, optionally within a trailing window; None where there is none."""
    return latest_partition(partitions_of(spark, table, column), end, lookback, column).first()[0]


def read_latest_listed(spark: SparkSession, table: str, end: str, lookback: int | None = None, column: str = "date") -> DataFrame:
    """The newest snapshot of a partitioned table: the catalog names the date, and the scan reads that partition alone."""
    day = latest_listed(spark, table, end, lookback, column)
    frame = spark.read.table(table)
    return frame.where(F.col(column) == day) if day is not None else frame.where(F.lit(False))


def latest_partition(df: DataFrame, end: str, lookback: int | None = None, column: str = "date") -> DataFrame:
    """One row: the newest date up to ``end``, optionally within a trailing window."""
    bounded = df.where(F.col(column) <= end)
    if lookback is not None:
        bounded = bounded.where(F.col(column) >= day_shift(end, -lookback))
    return bounded.agg(F.max(column).alias(column))


def read_latest(df: DataFrame, end: str, lookback: int | None = None, column: str = "date") -> DataFrame:
    """The newest snapshot up to ``end``.

    The date is a scalar subquery, so a partitioned source prunes to one folder.
    """
    return df.where(F.col(column) == latest_partition(df, end, lookback, column).scalar())
