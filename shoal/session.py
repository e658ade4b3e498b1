"""Session set-up and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "shoal", master: str | None = None,
                  shuffle_partitions: int | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """Session with UTC time, AQE and Arrow; the cluster's own settings win where present."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, because there all tasks share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="shoal-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_SPACES: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, in the innermost :func:`scratch_space` if there is one."""
    return "/".join([shared_dir(spark), "shoal", *_SPACES[-1:], f"{name}-{uuid.uuid4().hex}"])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_space(spark: SparkSession):
    """Frames that operators store inside the block are gone after it, so results must be written or collected within.

    Without it stored frames stay until somebody deletes the shared folder: a frame can't know when its last reader is done.
    """
    _SPACES.append(f"run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        remove(spark, "/".join([shared_dir(spark), "shoal", _SPACES.pop()]))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once under the shared folder and read back.

    For frames that several branches read: the plan starts anew, the columns are
    pruned per reader, and a lost executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(*frames: tuple[DataFrame, list[str]], dealt: bool = False):
    """Bucketed tables under the shared folder, one per frame and its keys; ``dealt`` frames lie by their keys already.

    For frames joined on the same keys many times: the bucketed side stays where
    it is. The catalog entries and the files go at the end of the block, when the
    results of the joins have been stored.
    """
    tables = []
    try:
        for df, keys in frames:
            spark, name = df.sparkSession, f"shoal_{uuid.uuid4().hex}"
            width = wide_partitions(spark)
            path = scratch_path(spark, "buckets")
            tables.append((spark, name, path))
            (df if dealt else df.repartition(width, *keys)).write.bucketBy(width, *keys).option("path", path).saveAsTable(name, format="parquet")
        yield [spark.read.table(name) for spark, name, _ in tables]
    finally:
        for spark, name, path in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(spark, path)


def wide_partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle whose rows multiply in the next join.

    AQE judges a shuffle by its size and would merge its partitions into few,
    so these shuffles name their number, the session's shuffle width.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
