"""Counts from footers equal those of a scan, and the plan reads no column."""

import pytest
from pyspark.sql import functions as F

from tripflow.operators import profile
from tripflow.sources.statistics import statistics_scan, stored_null_profile


def table(spark, path, months=((1, 10), (2, 20))):
    for month, n in months:
        (spark.range(n).selectExpr("id", f"CASE WHEN id % {month + 2} = 0 THEN NULL ELSE CAST(id AS double) END AS v")
         .repartition(2).write.parquet(f"{path}/partition_year=2023/partition_month={month}"))
    return spark.read.parquet(path)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_partition_counts_are_pushed(spark, tmp_dir):
    scan = table(spark, f"{tmp_dir}/t")
    pushed = profile.partition_counts(statistics_scan(spark, f"{tmp_dir}/t"), feed="x")
    assert "PushedAggregation: [COUNT(*)]" in pushed._jdf.queryExecution().toString()
    assert rows(pushed) == rows(profile.partition_counts(scan, feed="x")) == [("x", 2023, 1, 10), ("x", 2023, 2, 20)]
    window = profile.rows_per_month(statistics_scan(spark, f"{tmp_dir}/t"), 2023, 2, 2)
    assert "PushedAggregation: [COUNT(*)]" in window._jdf.queryExecution().toString()
    assert rows(window) == [("2023-02", 20)]


def test_null_profile_is_pushed(spark, tmp_dir):
    scan = table(spark, f"{tmp_dir}/t")
    plan = profile.null_profile(statistics_scan(spark, f"{tmp_dir}/t"), ["id", "v"])._jdf.queryExecution().toString()
    assert "COUNT(id)" in plan.split("PushedAggregation")[1][:80]
    got = stored_null_profile(spark, f"{tmp_dir}/t", ["id", "v"], feed="x")
    assert rows(got) == rows(profile.null_profile(scan, ["id", "v"], feed="x"))


def test_a_file_without_the_column_is_scanned(spark, tmp_dir):
    table(spark, f"{tmp_dir}/t")
    spark.range(5).write.parquet(f"{tmp_dir}/t/partition_year=2023/partition_month=3")
    got = {r.coluna: (r.total, r.nulos) for r in stored_null_profile(spark, f"{tmp_dir}/t", ["id", "v"]).collect()}
    assert got == {"id": (35, 0), "v": (35, 4 + 5 + 5)}
    assert profile.partition_counts(statistics_scan(spark, f"{tmp_dir}/t", merge=True)).agg(F.sum("total_linhas")).first()[0] == 35


def test_the_setting_is_put_back(spark, tmp_dir):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with pytest.raises(Exception):
        statistics_scan(spark, f"{tmp_dir}/absent")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
