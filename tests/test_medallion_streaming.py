"""End-to-end medallion run on disk (J6) and the incremental stream."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripflow.plans import layers
from tripflow.plans.medallion import Lake, ingest_bronze_from_landing, run_all
from tripflow.plans.oracle import ORACLES
from tripflow.plans.sql_forms import read_back
from tripflow.sources.feeds import raw_feed_b, raw_feeds
from tripflow.sources.landing import land_feed
from tripflow.specs import FEED_A, FEED_B, TESTDATA_QUALITY
from tripflow.streaming.incremental_ingest import run_bronze_ingest_once


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_run_all_matches_oracles(spark, tmp_dir, duck):
    lake = Lake(tmp_dir, "e2e_bronze", "e2e_silver", "e2e_gold")
    log = {(r.stage, r.feed): r.rows for r in
           run_all(spark, raw_feeds(spark, SF_SMALL), {"yellow": FEED_A, "green": FEED_B}, lake,
                   TESTDATA_QUALITY).collect()}
    counts = {(r[0], r[1]): r[2] for r in duck.execute(ORACLES["layer_counts"]).fetchall()}
    assert log[("bronze", "yellow")] == counts[("bronze", "yellow")]
    assert log[("silver", "green")] == counts[("silver", "green")]
    assert log[("gold", "all")] == counts[("gold", "yellow")] + counts[("gold", "green")]
    monthly = [tuple(r) for r in read_back(spark, "e2e_gold.avg_total_amount").collect()]
    assert monthly == duck.execute(ORACLES["avg_amount_by_month"]).fetchall()
    hourly = [tuple(r) for r in read_back(spark, "e2e_gold.avg_passengers", hourly=True).collect()]
    assert hourly == duck.execute(ORACLES["avg_passengers_by_hour"]).fetchall()
    gold = spark.table("e2e_gold.all_trips")
    assert gold.count() == len(duck.execute(ORACLES["gold_all"]).fetchall())


def test_landing_ingest_matches_lazy_bronze(spark, tmp_dir):
    land_feed(raw_feed_b(spark, SF_SMALL), FEED_B, tmp_dir + "/landing")
    lake = Lake(tmp_dir + "/lake", "l_bronze", "l_silver", "l_gold")
    lake.create_databases(spark)
    status = ingest_bronze_from_landing(spark, FEED_B, tmp_dir + "/landing/green", lake)
    assert status.filter("status = 'missing'").count() > 0  # feed B ends before 2001-12
    landed = spark.table("l_bronze.green_trips").select("vendorid", "total_amount", "partition_year",
                                                        "partition_month")
    lazy = layers.bronze(spark, SF_SMALL, "green").select("vendorid", "total_amount", "partition_year",
                                                          "partition_month")
    assert landed.exceptAll(lazy).count() == 0 and lazy.exceptAll(landed).count() == 0


def test_stream_picks_up_only_new_months(spark, tmp_dir):
    raw = raw_feed_b(spark, SF_SMALL)
    land_feed(raw.filter(F.col("partition_year") < 1997), FEED_B, tmp_dir + "/landing")
    first = run_bronze_ingest_once(spark, FEED_B, tmp_dir + "/landing/green", tmp_dir + "/bronze", tmp_dir + "/ck")
    land_feed(raw.filter(F.col("partition_year") == 1997), FEED_B, tmp_dir + "/landing", mode="append")
    second = run_bronze_ingest_once(spark, FEED_B, tmp_dir + "/landing/green", tmp_dir + "/bronze", tmp_dir + "/ck")
    assert first == raw.filter(F.col("partition_year") < 1997).count()
    assert second == raw.filter(F.col("partition_year") == 1997).count()
    assert spark.read.parquet(tmp_dir + "/bronze").count() == first + second


def test_rerun_is_idempotent(spark, tmp_dir):
    lake = Lake(tmp_dir, "re_bronze", "re_silver", "re_gold")
    specs = {"yellow": FEED_A, "green": FEED_B}
    first = run_all(spark, raw_feeds(spark, SF_SMALL), specs, lake, TESTDATA_QUALITY).collect()
    before = sorted(tuple(r) for r in spark.table("re_gold.avg_total_amount").collect())
    second = run_all(spark, raw_feeds(spark, SF_SMALL), specs, lake, TESTDATA_QUALITY).collect()
    after = sorted(tuple(r) for r in spark.table("re_gold.avg_total_amount").collect())
    assert [(r.stage, r.feed, r.rows) for r in first] == [(r.stage, r.feed, r.rows) for r in second]
    assert before == after
    assert spark.table("re_bronze.yellow_trips").count() == first[0].rows


def test_stream_runs_in_bounded_micro_batches(spark, tmp_dir):
    from tripflow.streaming.incremental_ingest import start_bronze_ingest

    raw = raw_feed_b(spark, SF_SMALL)
    land_feed(raw, FEED_B, tmp_dir + "/landing")
    q = start_bronze_ingest(spark, FEED_B, tmp_dir + "/landing/green", tmp_dir + "/bronze", tmp_dir + "/ck",
                            max_files_per_trigger=10)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if int(p.get("numInputRows", 0)) > 0]
    assert len(batches) > 1
    assert sum(int(p["numInputRows"]) for p in batches) == raw.count()
