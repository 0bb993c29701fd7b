"""Sinks (K1-K5) and catalog operations."""

import os

import pytest
from pyspark.sql import functions as F

from tripflow.sources import catalog
from tripflow.sources import sinks
from tripflow.sources.sinks import current_version, publish_result, write_partitioned


def _frame(spark, months, value):
    return spark.createDataFrame([(value, 2023, m) for m in months], "v long, partition_year int, partition_month int")


def test_dynamic_overwrite_keeps_other_months(spark, tmp_dir):
    path = tmp_dir + "/t"
    write_partitioned(_frame(spark, [1, 2, 3], 1), path, overwrite="dynamic")
    rows = write_partitioned(_frame(spark, [2], 9), path, overwrite="dynamic")
    assert rows == 1
    got = sorted((r.partition_month, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (2, 9), (3, 1)]


def test_static_overwrite_replaces_table(spark, tmp_dir):
    path = tmp_dir + "/t"
    write_partitioned(_frame(spark, [1, 2, 3], 1), path, overwrite="static")
    write_partitioned(_frame(spark, [2], 9), path, overwrite="static", layout="preserve")
    assert [(r.partition_month, r.v) for r in spark.read.parquet(path).collect()] == [(2, 9)]


def test_exact_partition_paths(spark, tmp_dir):
    path = tmp_dir + "/t"
    write_partitioned(_frame(spark, [1, 5], 1), path)
    assert sorted(os.listdir(path + "/partition_year=2023")) == ["partition_month=1", "partition_month=5"]


def test_bad_mode_rejected(spark, tmp_dir):
    with pytest.raises(ValueError):
        write_partitioned(_frame(spark, [1], 1), tmp_dir + "/t", overwrite="append")


def test_result_is_one_file(spark, tmp_dir):
    df = spark.range(24).select(F.col("id").cast("int").alias("hora")).repartition(4)
    rows, at = publish_result(df, tmp_dir + "/r")
    assert rows == 24 and at == current_version(spark, tmp_dir + "/r")
    assert len([f for f in os.listdir(at) if f.endswith(".parquet")]) == 1


def test_catalog_create_list_recover(spark, tmp_dir):
    path = tmp_dir + "/silver"
    write_partitioned(_frame(spark, [1, 2], 3), path)
    catalog.create_databases(spark, ["t_silver_db"])
    catalog.create_table(spark, "t_silver_db.trips", [("v", "bigint", "a value")], path, catalog.PARTITION_DDL)
    catalog.recover_partitions(spark, "t_silver_db.trips")
    assert spark.table("t_silver_db.trips").count() == 2
    tables = {r.name: r.tableType for r in catalog.list_tables(spark, "t_silver_db").collect()}
    assert tables == {"trips": "EXTERNAL"}
    cols = {r.name: (r.dataType, r.isPartition, r.description) for r in
            catalog.list_columns(spark, "t_silver_db.trips").collect()}
    assert cols["v"] == ("bigint", False, "a value") and cols["partition_month"][1] is True


def test_discovery_merges_new_columns(spark, tmp_dir):
    path = tmp_dir + "/bronze"
    write_partitioned(_frame(spark, [1], 1), path)
    catalog.create_databases(spark, ["t_bronze_db"])
    assert catalog.register_discovered(spark, "t_bronze_db.trips", path) == []
    wider = _frame(spark, [2], 2).withColumn("airport_fee", F.lit(1.5))
    write_partitioned(wider, path, overwrite="dynamic")
    assert catalog.register_discovered(spark, "t_bronze_db.trips", path) == ["airport_fee"]
    names = [c.name for c in spark.catalog.listColumns("t_bronze_db.trips")]
    assert "airport_fee" in names and "v" in names
    spark.catalog.refreshTable("t_bronze_db.trips")
    assert spark.table("t_bronze_db.trips").count() == 2


def test_hot_month_is_split_across_files(spark, tmp_dir):
    """One month holds over a third of the rows: the rebalance write must not
    funnel it through one task (AQE splits the skewed partition)."""
    hot = spark.range(60000).select(
        F.col("id").alias("v"), F.lit(2023).alias("partition_year"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 11 + 2).cast("int")).alias("partition_month"),
    ).repartition(8)
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = write_partitioned(hot, tmp_dir + "/t")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert rows == 60000
    hot_files = [f for f in os.listdir(tmp_dir + "/t/partition_year=2023/partition_month=1") if f.endswith(".parquet")]
    assert len(hot_files) > 1
    assert spark.read.parquet(tmp_dir + "/t").filter("partition_month = 1").count() == 20000


def test_partitions_gone_from_the_folder_leave_the_catalog(spark, tmp_dir):
    path = tmp_dir + "/sync"
    write_partitioned(_frame(spark, [1, 2], 3), path)
    catalog.create_databases(spark, ["t_sync_db"], tmp_dir)
    catalog.create_table(spark, "t_sync_db.trips", [("v", "bigint", "a value")], path, catalog.PARTITION_DDL)
    catalog.recover_partitions(spark, "t_sync_db.trips")
    write_partitioned(_frame(spark, [2], 4), path, overwrite="static")
    catalog.recover_partitions(spark, "t_sync_db.trips")
    assert [r[0] for r in spark.sql("SHOW PARTITIONS t_sync_db.trips").collect()] == ["partition_year=2023/partition_month=2"]


def test_a_failed_result_leaves_the_old_version(spark, tmp_dir):
    path = tmp_dir + "/kept"
    publish_result(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        publish_result(spark.range(20).select(F.expr("id + CAST(raise_error('broken') AS long) AS id")), path)
    assert spark.read.parquet(current_version(spark, path)).count() == 3
    assert publish_result(spark.range(20_000), path)[0] == 20_000  # no limit on the size
    assert spark.read.parquet(current_version(spark, path)).count() == 20_000


def test_readers_of_a_result_see_the_old_rows_or_the_new_ones(spark, tmp_dir):
    path, ddl = tmp_dir + "/r", [("id", "bigint", "a number")]
    catalog.create_databases(spark, ["t_publish_db"])
    for n in (3, 5, 8):
        before = spark.table("t_publish_db.r") if n > 3 else None
        old = {3: None, 5: 3, 8: 5}[n]
        rows, at = publish_result(spark.range(n), path)
        if before is not None:  # written, not yet published
            assert before.count() == old and spark.table("t_publish_db.r").count() == old
        catalog.publish(spark, "t_publish_db.r", ddl, at)
        assert spark.table("t_publish_db.r").count() == n
        if before is not None:
            assert len(before.collect()) == old  # planned before the change: its files are still there
    assert sorted(d for d in os.listdir(path) if d.startswith("v")) == ["v00000002", "v00000003"]


def test_a_table_that_differs_raises(spark, tmp_dir):
    catalog.create_databases(spark, ["t_truth_db"])
    ddl = [("id", "bigint", "a number")]
    publish = tmp_dir + "/a"
    spark.range(2).write.parquet(publish)
    catalog.create_table(spark, "t_truth_db.t", ddl, publish)
    catalog.create_table(spark, "t_truth_db.t", ddl, "file://" + publish + "/")  # the same place
    with pytest.raises(ValueError, match="other columns"):
        catalog.create_table(spark, "t_truth_db.t", [("id", "int", "")], publish)
    with pytest.raises(ValueError, match="not at"):
        catalog.create_table(spark, "t_truth_db.t", ddl, tmp_dir + "/b")


def test_partitions_of_one_write_are_added_without_a_listing(spark, tmp_dir):
    path = tmp_dir + "/t"
    catalog.create_databases(spark, ["t_diff_db"])
    write_partitioned(_frame(spark, [1], 1), path)
    catalog.register_discovered(spark, "t_diff_db.t", path)
    write_partitioned(_frame(spark, [2, 3], 2), path, overwrite="dynamic")
    catalog.register_discovered(spark, "t_diff_db.t", path, schema=spark.read.parquet(path).schema,
                                written=[{"partition_year": 2023, "partition_month": 2}])
    # Month 3 lies in the folder, but is not of this write: it was not looked for.
    assert sorted(r[0] for r in spark.sql("SHOW PARTITIONS t_diff_db.t").collect()) == [f"partition_year=2023/partition_month={m}" for m in (1, 2)]
    with pytest.raises(ValueError, match="not at"):
        catalog.register_discovered(spark, "t_diff_db.t", tmp_dir + "/other", schema=spark.read.parquet(path).schema)


def test_what_a_task_sorts_is_bounded(spark, tmp_dir, monkeypatch):
    """Tasks of a write without a shuffle read bounded pieces, whatever the session's split size, and write bounded files."""
    table = spark.range(0, 6000, 1, 6).select(
        F.lit(2023).alias("partition_year"), (F.col("id") % 2 + 1).cast("int").alias("partition_month"), F.xxhash64("id").alias("key"))
    table.write.parquet(tmp_dir + "/in")
    packed = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.maxPartitionBytes": "256m"}
    for key, value in packed.items():  # all files are one scan task
        spark.conf.set(key, value)
    monkeypatch.setattr(sinks, "SORT_SCAN_BYTES", 1 << 10)
    monkeypatch.setattr(sinks, "FILE_ROWS", 300)
    try:
        source = spark.read.parquet(tmp_dir + "/in")
        assert source.rdd.getNumPartitions() == 1
        assert write_partitioned(source, tmp_dir + "/a", layout="preserve", sort_within=("key",)) == 6000
        assert sinks.write_months(source, tmp_dir + "/b", ["2023-01", "2023-02"], sort_within=("key",)) == {"2023-01": 3000, "2023-02": 3000}
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "256m"
    finally:
        for key in packed:
            spark.conf.unset(key)
    for out in ("/a", "/b"):
        files = spark.read.parquet(tmp_dir + out).groupBy(F.col("_metadata.file_name").alias("name"), "partition_month").count().collect()
        assert max(r["count"] for r in files) == 300
        assert len({r["name"].split("-")[1] for r in files}) == 6  # tasks that wrote
