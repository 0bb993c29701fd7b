"""The driver contract: entry(), queries() and oracle_sql() agree.

Every registered query is checked against its DuckDB oracle on the small
tables (the brute-force check of the whole plan, not a sample).
"""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tripflow.plans.registry import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, float(f"{v:.9g}"))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (4, v)


def _key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["mes", "avg_total_amount"]
    assert df.count() >= 0


def test_every_key_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(set(QUERIES) & set(entry.oracle_sql())))
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _key(sdf.columns, srows) == _key(ocols, orows)


@pytest.mark.parametrize("key", ["silver_feed_a", "silver_feed_b", "cast_failures", "gold_all", "avg_passengers_by_hour"])
def test_cast_sensitive_keys_hold_without_ansi(spark, duck, key):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        sdf = entry.queries()[key](spark, SF_SMALL)
        srows = [tuple(r) for r in sdf.collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    res = duck.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert _key(sdf.columns, srows) == _key(ocols, res.fetchall())


@pytest.mark.parametrize("key", ["volume_by_month", "sample_month"])
def test_window_keys_prune_partitions(spark, key):
    from tripflow.plans.inspect import plan_text

    plan = plan_text(entry.queries()[key](spark, SF_SMALL))
    filters = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    assert filters and all("partition_year" in f and "partition_month" in f for f in filters)
