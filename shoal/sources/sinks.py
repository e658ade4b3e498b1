"""Writers: partitions, JSON lines, single files, keyed merges and JDBC upserts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F


def overwrite_partition(df: DataFrame, base: str, partition: dict[str, str], marked: bool = True) -> str:
    """Replace one static partition of a path-partitioned table and return its folder.

    The folder gets a ``_SUCCESS`` mark, unless more is to be written before it counts as complete.
    """
    folder = "/".join([base, *[f"{k}={v}" for k, v in partition.items()]])
    mark = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": str(marked).lower()}
    df.write.mode("overwrite").options(**mark).parquet(folder)
    return folder


def overwrite_partitions(df: DataFrame, base: str, by: list[str], rows_per_file: int = 5_000_000) -> None:
    """Replace only the partitions present in the frame, in one write.

    Rows stay where they are; a partition holding most of the rows is not
    pulled into one task, and ``maxRecordsPerFile`` bounds its files.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(base))


def add_partition(spark: SparkSession, table: str, partition: dict[str, str]) -> None:
    spec = ", ".join(f"{k}='{v}'" for k, v in partition.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")


def write_json_lines(df: DataFrame, path: str, partitions: int | None = None) -> None:
    (df if partitions is None else df.coalesce(partitions)).write.mode("overwrite").json(path)


def append_table(df: DataFrame, table: str) -> None:
    """Add the rows to an existing table, columns by name."""
    df.select(*df.sparkSession.read.table(table).columns).write.insertInto(table)


def write_single_file(df: DataFrame, path: str, kind: str = "csv", options: dict[str, str] | None = None) -> None:
    """One named file, for small report frames only: the rows pass through one task by request."""
    spark = df.sparkSession
    staging = f"{path}.staging"
    df.coalesce(1).write.mode("overwrite").options(**(options or {})).format(kind).save(staging)
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    fs = path_class(path).getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(path_class(staging)) if s.getPath().getName().startswith("part-"))
    fs.delete(path_class(path), False)
    fs.rename(part, path_class(path))
    fs.delete(path_class(staging), True)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows win, old rows stay where no new row has their key."""
    return old.join(new, keys, "left_anti").unionByName(new)


def refresh_keeping(new: DataFrame, target: DataFrame, key: str, kept: list[str]) -> DataFrame:
    """Full refresh in the target's column order, keeping the target's own score columns."""
    return new.drop(*kept).join(target.select(key, *kept), key, "left").select(*target.columns)


def gate_reject_rate(results: DataFrame, ok: str = "ok", limit: float = 0.1) -> DataFrame:
    """``accepted, rejected``; the query fails when more than ``limit`` of the rows were rejected."""
    counts = results.agg(F.count_if(F.col(ok)).alias("accepted"), F.count_if(~F.col(ok)).alias("rejected"))
    share = F.try_divide(F.col("rejected"), F.col("accepted") + F.col("rejected"))
    passed = F.assert_true(F.coalesce(share, F.lit(0.0)) <= limit, F.lit("too many rejected rows")).isNull()
    return counts.where(passed)


def write_rows(df: DataFrame, connect: Callable, statement: str, columns: list[str], attempts: int = 3,
               limit: float = 0.1, pause: float = 0.5) -> dict[str, int]:
    """Upserts through a DB-API connection opened once per partition.

    ``connect`` returns a connection and ``statement`` is a prepared
    insert-or-update with one placeholder per column. A batch goes in one
    transaction; only the rows of a failed batch are tried one by one, each
    ``attempts`` times. The write fails when more than ``limit`` stay rejected.
    """

    def write(batches: Iterable) -> Iterable:
        import pandas as pd

        connection = connect()
        good = bad = 0

        def sent(rows: list[tuple]) -> bool:
            try:
                connection.cursor().executemany(statement, rows)
                connection.commit()
            except Exception:  # noqa: BLE001 - any driver error counts as a failed try
                connection.rollback()
                return False
            return True

        def sent_at_last(row: tuple) -> bool:
            for attempt in range(attempts):
                if attempt:
                    time.sleep(pause)
                if sent([row]):
                    return True
            return False

        try:
            for batch in batches:
                rows = list(batch[columns].itertuples(index=False, name=None))
                accepted = len(rows) if not rows or sent(rows) else sum(sent_at_last(row) for row in rows)
                good, bad = good + accepted, bad + len(rows) - accepted
        finally:
            connection.close()
        yield pd.DataFrame({"accepted": [good], "rejected": [bad]})

    counts: Row = (df.select(*columns).mapInPandas(write, "accepted long, rejected long")
                   .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")).first())
    accepted, rejected = counts.accepted or 0, counts.rejected or 0
    if rejected > limit * (accepted + rejected):
        raise RuntimeError(f"{rejected} of {accepted + rejected} rows were rejected")
    return {"accepted": accepted, "rejected": rejected}
