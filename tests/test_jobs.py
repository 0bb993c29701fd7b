"""The per-stage job entry points, run as separate processes (no shared catalog)."""

import os
import subprocess
import sys

import duckdb

from tests.conftest import SF_SMALL
from tripflow.plans.oracle import ORACLES
from tripflow.sources.feeds import raw_feeds
from tripflow.sources.landing import land_feed
from tripflow.sources.sinks import current_version
from tripflow.specs import FEED_A, FEED_B

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
WINDOW = ["--year", "1997", "--window-first", "1", "--window-last", "5", "--hourly-month", "5",
          "--first-month", "1995-01", "--last-month", "2001-12", "--master", "local[2]"]


def _job(*args):
    out = subprocess.run([sys.executable, os.path.join(REPO, "tripflow", "jobs.py"), *args, *WINDOW],
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_stages_as_separate_jobs(spark, tmp_dir):
    feeds = raw_feeds(spark, SF_SMALL)
    land_feed(feeds["yellow"], FEED_A, tmp_dir + "/landing")
    land_feed(feeds["green"], FEED_B, tmp_dir + "/landing")
    lake = tmp_dir + "/lake"
    bronze = _job("bronze", "--landing", tmp_dir + "/landing", "--lake", lake)
    assert "bronze yellow 2001-12 missing" in bronze and "bronze green 1997-01 ok" in bronze
    assert "bronze yellow sucessos=83 falhas=1" in bronze
    assert "silver yellow rows=" in _job("silver", "--lake", lake)
    assert "gold all rows=" in _job("gold", "--lake", lake)
    _job("monthly", "--lake", lake)
    _job("hourly", "--lake", lake)
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    monthly = sorted(tuple(r) for r in spark.read.parquet(current_version(spark, lake + "/gold/avg_total_amount")).collect())
    assert monthly == sorted(con.execute(ORACLES["avg_amount_by_month"]).fetchall())
    hourly = sorted(tuple(r) for r in spark.read.parquet(current_version(spark, lake + "/gold/avg_passengers")).collect())
    assert hourly == sorted(con.execute(ORACLES["avg_passengers_by_hour"]).fetchall())


def test_audit_every_layer(spark, tmp_dir, capsys):
    from tripflow.jobs import audit
    from tripflow.plans.medallion import Lake, run_all
    from tripflow.specs import TESTDATA_QUALITY

    feeds = raw_feeds(spark, SF_SMALL)
    land_feed(feeds["yellow"], FEED_A, tmp_dir + "/landing")
    land_feed(feeds["green"], FEED_B, tmp_dir + "/landing")
    lake = Lake(tmp_dir + "/lake", "au_bronze", "au_silver", "au_gold")
    run_all(spark, feeds, {"yellow": FEED_A, "green": FEED_B}, lake, TESTDATA_QUALITY)
    for layer in ("source", "bronze", "silver", "gold"):
        audit(spark, layer, [FEED_A, FEED_B], lake, TESTDATA_QUALITY, tmp_dir + "/landing")
    out = capsys.readouterr().out
    for title in ("yellow: month status", "green: schema drift", "column comparison", "bronze yellow: nulls",
                  "silver green: passengers", "silver yellow: amount by month", "gold: summary", "gold: filter audit"):
        assert f"== {title}" in out, title
    assert "missing" in out  # feed B ends before the last expected month
