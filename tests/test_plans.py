"""Physical-plan checks: the plans are the ones we want at scale."""

import pytest

from tests.conftest import SF_SMALL
from tripflow.operators.aggregates import avg_amount_by_month
from tripflow.operators.ingest import to_bronze
from tripflow.operators.standardize import to_silver
from tripflow.plans import layers
from tripflow.plans.inspect import count_exchanges, plan_text
from tripflow.sources.feeds import raw_feed_a
from tripflow.sources.sinks import prepare_layout, write_partitioned
from tripflow.specs import FEED_A, TESTDATA_QUALITY as Q


@pytest.fixture(scope="module")
def bronze_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "bronze")
    write_partitioned(to_bronze(raw_feed_a(spark, SF_SMALL), FEED_A), path)
    return path


def test_bronze_write_rebalances_once(spark):
    df = prepare_layout(to_bronze(raw_feed_a(spark, SF_SMALL), FEED_A))
    text = plan_text(df, "simple")
    assert count_exchanges(df) == 1 and "REBALANCE_PARTITIONS_BY_COL" in text


def test_silver_write_is_map_only(spark, bronze_table):
    silver = to_silver(spark.read.parquet(bronze_table), FEED_A)
    df = prepare_layout(silver, layout="preserve", sort_within=("pickup_datetime",))
    assert count_exchanges(df) == 0


def test_scan_reads_only_needed_columns(spark):
    plan = plan_text(avg_amount_by_month(layers.gold(spark, SF_SMALL, Q)))
    schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    for unused in ("l_partkey", "l_discount", "l_tax", "l_linestatus"):
        assert unused not in schema
    assert "orders" not in plan  # the green branch is pruned away for a yellow-only question


def test_partition_filter_prunes(spark, bronze_table):
    from tripflow.operators import profile

    plan = plan_text(profile.rows_per_month(spark.read.parquet(bronze_table), 1997, 1, 5))
    pf = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert "partition_year" in pf and "partition_month" in pf


def test_aggregate_is_partial_before_shuffle(spark):
    plan = plan_text(avg_amount_by_month(layers.gold(spark, SF_SMALL, Q)), "simple")
    assert "partial_avg" in plan


def test_small_sides_are_broadcast_after_a_size_check(spark):
    import __spark_entry__ as entry

    df = entry.queries()["missing_months"](spark, SF_SMALL)
    df.collect()  # AQE re-plans with the measured sizes
    final = plan_text(df, "simple")
    assert "isFinalPlan=true" in final
    assert "BroadcastHashJoin" in final and "LeftAnti" in final
