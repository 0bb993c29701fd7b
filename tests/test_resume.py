"""A rerun does what is left to do, and no more."""

import datetime
import shutil

import pytest

from tests.conftest import SF_SMALL
from tripflow.plans import medallion
from tripflow.plans.manifest import Manifest, fingerprint
from tripflow.plans.medallion import Lake, run_all
from tripflow.session import filesystem
from tripflow.sources.feeds import raw_feeds
from tripflow.sources.landing import land_feed
from tripflow.sources.sinks import write_partitioned
from tripflow.specs import FEED_A, FEED_B, QualitySpec, TESTDATA_QUALITY

SPECS = {"yellow": FEED_A, "green": FEED_B}


def ran(log):
    """Stages that did work, and all rows by stage."""
    rows = log.collect()
    return {(r.stage, r.feed) for r in rows if r.seconds > 0}, {(r.stage, r.feed): r.rows for r in rows}


def test_a_run_that_died_after_silver_starts_at_gold(spark, tmp_dir, monkeypatch):
    lake = Lake(tmp_dir, "rs_b", "rs_s", "rs_g")
    raws = raw_feeds(spark, SF_SMALL)
    with monkeypatch.context() as m:
        m.setattr(medallion, "consolidate_gold", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            run_all(spark, raws, SPECS, lake, TESTDATA_QUALITY)
    with monkeypatch.context() as m:  # Bronze is not read, nor written
        for name in ("ingest_bronze", "standardize_silver"):
            m.setattr(medallion, name, lambda *a: (_ for _ in ()).throw(AssertionError("done before")))
        worked, rows = ran(run_all(spark, raws, SPECS, lake, TESTDATA_QUALITY, resume=True))
    assert worked == {("gold", "all"), ("avg_total_amount", "yellow"), ("avg_passengers", "all")}
    assert rows["silver", "yellow"] == spark.table("rs_s.yellow_trips").count()
    assert ran(run_all(spark, raws, SPECS, lake, TESTDATA_QUALITY, resume=True)) == (set(), rows)
    # A new catalog over the same folders gets the tables of the skipped stages.
    other = Lake(tmp_dir, "rt_b", "rt_s", "rt_g")
    assert ran(run_all(spark, raws, SPECS, other, TESTDATA_QUALITY, resume=True))[0] == set()
    for table in ("b.yellow_trips", "s.green_trips", "g.all_trips", "g.avg_passengers"):
        assert spark.table("rt_" + table).count() == spark.table("rs_" + table).count() > 0
    # Other parameters, or an output that was touched, are worked again.
    narrow = TESTDATA_QUALITY.__class__(**{**TESTDATA_QUALITY.__dict__, "last_month": TESTDATA_QUALITY.last_month - 1, "hourly_month": TESTDATA_QUALITY.first_month})
    assert ran(run_all(spark, raws, SPECS, lake, narrow, resume=True))[0] == {("gold", "all"), ("avg_total_amount", "yellow"), ("avg_passengers", "all")}
    shutil.copytree(lake.path("silver", "green_trips"), lake.path("silver", "green_trips") + "/partition_year=1990", dirs_exist_ok=False)
    assert ("silver", "green") in ran(run_all(spark, raws, SPECS, lake, narrow, resume=True))[0]


def test_a_month_that_lands_again_is_worked_again(spark, tmp_dir):
    lake = Lake(tmp_dir + "/lake", "rl_b", "rl_s", "rl_g")
    feeds = raw_feeds(spark, SF_SMALL)
    raws = {tag: land_feed(feeds[tag].where("partition_year = 1997"), spec, tmp_dir + "/landing") for tag, spec in SPECS.items()}
    first = ran(run_all(spark, raws, SPECS, lake, TESTDATA_QUALITY))[1]
    assert ran(run_all(spark, raws, SPECS, lake, TESTDATA_QUALITY, resume=True)) == (set(), first)
    land_feed(feeds["green"].where("partition_year = 1997 AND partition_month = 2"), FEED_B, tmp_dir + "/landing", mode="append")
    worked, rows = ran(run_all(spark, raws, SPECS, lake, TESTDATA_QUALITY, resume=True))
    assert {("bronze", "green"), ("silver", "green"), ("gold", "all")} <= worked and not {("bronze", "yellow"), ("silver", "yellow")} & worked
    assert rows["bronze", "green"] == first["bronze", "green"] + feeds["green"].where("partition_year = 1997 AND partition_month = 2").count()


def test_fingerprints_and_broken_entries(spark, tmp_dir):
    spark.range(3).write.parquet(tmp_dir + "/a")
    one = fingerprint(spark, [tmp_dir + "/a"], 1)
    assert one == fingerprint(spark, [tmp_dir + "/a"], 1) != fingerprint(spark, [tmp_dir + "/a"], 2)
    spark.range(1).write.mode("append").parquet(tmp_dir + "/a")
    assert one != fingerprint(spark, [tmp_dir + "/a"], 1)
    m = Manifest(spark, tmp_dir)
    assert m.entry("x", "y") is None and m.done("x", "y", one) is None
    m.finish("x", "y", one, tmp_dir + "/a", 4)
    assert m.done("x", "y", one).rows == 4 and m.done("x", "y", "other") is None
    fs, p = filesystem(spark, tmp_dir + "/_manifest/x.y.json")
    out = fs.create(p, True)
    out.write(bytearray(b"{"))
    out.close()
    assert m.entry("x", "y") is None  # a broken entry is none
    m.finish("x", "y", one, tmp_dir + "/a", 5)
    assert m.entry("x", "y").rows == 5


def test_an_hourly_month_that_the_stored_gold_does_not_hold_raises(spark, tmp_dir):
    lake = Lake(tmp_dir, "rh_b", "rh_s", "rh_g")
    columns = "VendorID int, passenger_count int, total_amount double, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, taxi_type string, partition_year int, partition_month int"
    at = datetime.datetime(2023, 5, 2, 10)
    write_partitioned(spark.createDataFrame([(1, 2, 9.5, at, at, "yellow", 2023, 5)], columns), lake.path("gold", medallion.GOLD_TABLE))
    assert medallion.hourly_result(spark, lake, QualitySpec(), must_hold=True) == 1
    with pytest.raises(ValueError, match="2022-05"):
        medallion.hourly_result(spark, lake, QualitySpec(year=2022), must_hold=True)
    assert [tuple(r) for r in spark.table("rh_g.avg_passengers").collect()] == [(10, 2.0)]
