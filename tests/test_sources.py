"""Readers and writers."""

import sqlite3

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shoal.sources import dated, docs, jdbc, logs, sinks


def test_days_latest_and_partitions(spark, tmp_path):
    base = str(tmp_path / "t")
    for day, n in (("20240101", 1), ("20240103", 2), ("20240104", 3)):
        sinks.overwrite_partition(spark.range(n), base, {"date": day})
    got = {r.date: r.n for r in dated.read_days(spark, base, "20240101", "20240103").groupBy("date").agg(F.count("*").alias("n")).collect()}
    assert got == {"20240101": 1, "20240103": 2}
    assert dated.latest_complete_day(spark, base, "20240110") == "20240104"
    assert dated.latest_complete_day(spark, base, "20240102") == "20240101"
    assert dated.latest_complete_day(spark, base, "20240301") is None
    table = dated.read_days(spark, base, "20240101", "20240131")
    assert dated.read_latest(table, "20240103").count() == 2
    assert dated.read_latest(table, "20240301", lookback=30).count() == 0


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.overwrite_partitions(rows, base, ["p"])
    sinks.overwrite_partitions(rows.where("p = 'a'").withColumn("v", F.lit(9)), base, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(base).select("v", "p").collect()) == [(2, "b"), (9, "a")]


def test_docs_roundtrip(spark, tmp_path):
    lists = spark.createDataFrame([("l1", "a", 1.0), ("l1", "b", None), ("l2", "c", 2.0)], "id string, item string, score double")
    path = str(tmp_path / "docs")
    sinks.write_json_lines(docs.to_docs(lists), path)
    assert {r.id: r.apps for r in docs.read_doc_maps(spark, path).collect()} == {"l1": {"a": 1.0}, "l2": {"c": 2.0}}
    assert docs.read_doc_maps(spark, str(tmp_path / "absent")) is None


def test_single_file(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    sinks.write_single_file(spark.range(3), path, "csv", {"header": "true"})
    assert open(path).read().split() == ["id", "0", "1", "2"]


def test_fields_and_packed_values(spark):
    lines = spark.createDataFrame([("a,1,b",), ("broken,1",)], "value string")
    assert [tuple(r) for r in logs.split_rows(lines, ["x", "y", "z"]).collect()] == [("a", "1", "b")]
    rows = spark.createDataFrame([("p;20240101_a_b_c_d_x@y@z@1，2#t",), ("20240102_a",), (None,)], "packed string")
    fields = logs.experiment_fields("packed")
    got = [tuple(r) for r in rows.select(fields["exp_date"], fields["model_ids"]).collect()]
    assert got == [("20240101", ["1", "2"]), ("20240102", None), (None, None)]
    push = spark.createDataFrame([('{"param": "a|b|TASKabcd20240131093000"}',), ("{}",)], "extra string")
    got = [tuple(r) for r in push.select(*[c.alias(n) for n, c in logs.push_payload("extra").items()]).collect()]
    assert got == [("20240131", "09", "30", "TASK"), (None, None, None, None)]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = sinks.upsert(old, new, ["k"])
    assert sorted(once.collect()) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(sinks.upsert(once, new, ["k"]).collect()) == sorted(once.collect())


def test_reject_gate(spark):
    rows = spark.range(100).select((F.col("id") >= 10).alias("ok"))
    assert tuple(sinks.gate_reject_rate(rows).first()) == (90, 10)
    with pytest.raises(PySparkException):
        sinks.gate_reject_rate(rows, limit=0.05).collect()


def test_row_writer_with_an_in_process_database(spark, tmp_path):
    path = str(tmp_path / "db.sqlite")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE t (k INTEGER PRIMARY KEY, v TEXT CHECK (v <> 'bad'))")
    rows = spark.createDataFrame([(n, "x" if n else "bad") for n in range(20)], "k int, v string").coalesce(1)
    statement = "INSERT INTO t (k, v) VALUES (?, ?) ON CONFLICT (k) DO UPDATE SET v = excluded.v"
    connect = lambda: sqlite3.connect(path, timeout=30)
    assert sinks.write_rows(rows, connect, statement, ["k", "v"], attempts=2, pause=0) == {"accepted": 19, "rejected": 1}
    assert sqlite3.connect(path).execute("SELECT count(*) FROM t").fetchone() == (19,)
    with pytest.raises(RuntimeError):
        sinks.write_rows(rows, connect, statement, ["k", "v"], attempts=1, limit=0.01, pause=0)


def test_row_writer_sends_good_batches_whole(spark, tmp_path):
    path = str(tmp_path / "db.sqlite")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE t (k INTEGER PRIMARY KEY, v TEXT)")
    rows = spark.createDataFrame([(n % 30, str(n)) for n in range(60)], "k int, v string").coalesce(1)
    statement = "INSERT INTO t (k, v) VALUES (?, ?) ON CONFLICT (k) DO UPDATE SET v = excluded.v"
    assert sinks.write_rows(rows, lambda: sqlite3.connect(path, timeout=30), statement, ["k", "v"]) == {"accepted": 60, "rejected": 0}
    assert sqlite3.connect(path).execute("SELECT count(*), min(CAST(v AS INTEGER)) FROM t").fetchone() == (30, 30)
    assert sinks.write_rows(rows.limit(0), lambda: sqlite3.connect(path, timeout=30), statement, ["k", "v"]) == {"accepted": 0, "rejected": 0}


def test_unmarked_folder_is_not_complete(spark, tmp_path):
    base = str(tmp_path / "days")
    rows = spark.range(3)
    sinks.overwrite_partition(rows, base, {"date": "20240101"})
    sinks.overwrite_partition(rows, base, {"date": "20240102"}, marked=False)
    assert dated.latest_complete_day(spark, base, "20240103") == "20240101"
    assert dated.read_days(spark, base, "20240102", "20240102").count() == 3


def test_append_goes_by_name(spark):
    name = "append_by_name"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (a INT, b STRING, d STRING) USING parquet PARTITIONED BY (d)")
    try:
        sinks.append_table(spark.createDataFrame([("x", "u", 1)], "d string, b string, a int"), name)
        sinks.append_table(spark.createDataFrame([(2, "v", "x")], "a int, b string, d string"), name)
        assert sorted(map(tuple, spark.read.table(name).collect())) == [(1, "u", "x"), (2, "v", "x")]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_jdbc_options_carry_the_range(spark):
    options = jdbc.jdbc_options("jdbc:x", "t", "u", "p", "id", 0, 100, 4)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id" and options["dbtable"] == "t"


def test_every_oracle_has_its_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 184


def test_latest_snapshot_comes_from_the_catalog(spark):
    name = "shoal_test_latest"
    try:
        rows = spark.createDataFrame([(n, f"2024010{n % 4 + 1}") for n in range(20)], "v int, date string")
        rows.repartition("date").write.partitionBy("date").saveAsTable(name, format="parquet", mode="overwrite")
        assert sorted(r.date for r in dated.partitions_of(spark, name).collect()) == ["20240101", "20240102", "20240103", "20240104"]
        latest = dated.read_latest_listed(spark, name, "20240103")
        assert {(r.v, r.date) for r in latest.collect()} == {(n, "20240103") for n in range(2, 20, 4)}
        plan = latest._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "PartitionFilters: [isnotnull(date" in plan and "= 20240103)]" in plan
        assert latest.select("_metadata.file_path").distinct().count() == 1
        assert dated.latest_listed(spark, name, "20240301", 30) is None
        assert dated.read_latest_listed(spark, name, "20231231").count() == 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_scratch_space_and_buckets_leave_nothing(spark):
    import os

    from shoal.session import bucketed, scratch_path, scratch_space, stored

    with scratch_space(spark):
        kept = stored(spark.range(5).toDF("v"), "kept")
        with scratch_space(spark):
            inner = scratch_path(spark, "x")
            spark.range(3).write.parquet(inner)
        assert not os.path.exists(inner) and kept.count() == 5
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
        with bucketed((kept, ["v"])) as (table,):
            files = [f.removeprefix("file://") for f in table.inputFiles()]
            assert files and all(os.path.exists(f) for f in files)
        assert not any(os.path.exists(f) for f in files)
    assert not os.path.exists(folder)
    assert os.path.dirname(scratch_path(spark, "outside")).endswith("/shoal")
