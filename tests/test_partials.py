"""States merge to what one scan gives, and a replaced month costs that month."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripflow.operators import aggregates, partials, profile
from tripflow.plans import incremental, layers
from tripflow.plans.medallion import GOLD_TABLE, Lake, ingest_bronze, run_all
from tripflow.sources.feeds import raw_feeds
from tripflow.specs import FEED_A, FEED_B, TESTDATA_QUALITY as Q


def rows(df):
    return [tuple(r) for r in df.collect()]


def close(a, b):
    return len(a) == len(b) and all(x == pytest.approx(y) for p, q in zip(a, b) for x, y in zip(p, q))


def test_merged_states_equal_the_scan(spark):
    data = [(k % 3, k % 7, None if k % 11 == 0 else 1e6 + k * 0.37 if k % 2 else -1.0 * k) for k in range(500)] + [(9, 0, None), (8, 1, 5.0)]
    df = spark.createDataFrame(data, "g int, part int, x double")
    merged = partials.merge(partials.states(df, ["g", "part"], ["x"]), ["g"], ["x"])
    got = merged.select("g", "linhas", "x_n", partials.mean("x"), partials.stddev("x"), "x_min", "x_max", "x_low").orderBy("g")
    want = df.groupBy("g").agg(F.count(F.lit(1)), F.count("x"), F.avg("x"), F.stddev_samp("x"), F.min("x"), F.max("x"),
                               F.count_if(F.col("x") <= 0)).orderBy("g")
    assert close(rows(got), rows(want))
    assert partials.merge(partials.states(df.limit(0), ["g", "part"], ["x"]), ["g"], ["x"]).count() == 0


def test_states_of_states_equal_the_scan(spark):
    df = spark.range(300).selectExpr("id % 2 AS g", "id % 5 AS a", "id % 3 AS b", "sqrt(id) * 100 AS x")
    once = partials.merge(partials.states(df, ["g", "a", "b"], ["x"]), ["g", "a"], ["x"])
    twice = partials.merge(once, ["g"], ["x"]).select("g", partials.stddev("x")).orderBy("g")
    assert close(rows(twice), rows(df.groupBy("g").agg(F.stddev_samp("x")).orderBy("g")))


def results(spark, lake):
    gold, silver = spark.read.parquet(lake.path("gold", GOLD_TABLE)), spark.read.parquet(lake.path("silver", "yellow_trips"))
    of_gold, of_silver = incremental.gold_states(spark, lake), incremental.silver_states(spark, lake, FEED_A)
    assert close(rows(partials.avg_amount_by_month(of_gold)), rows(aggregates.avg_amount_by_month(gold)))
    assert close(rows(partials.avg_passengers_by_hour(of_gold, Q)), rows(aggregates.avg_passengers_by_hour(gold, Q)))
    assert close(rows(partials.gold_summary(of_gold)), rows(profile.gold_summary(gold)))
    assert close(rows(partials.amount_stats_by_month(of_silver).na.fill(-1)), rows(profile.amount_stats_by_month(silver).na.fill(-1)))


def test_a_replaced_month_recomputes_one_partition(spark, tmp_dir):
    lake, specs = Lake(tmp_dir, "pt_b", "pt_s", "pt_g"), {"yellow": FEED_A, "green": FEED_B}
    raws = {tag: df.where("partition_year = 1997") for tag, df in raw_feeds(spark, SF_SMALL).items()}
    run_all(spark, raws, specs, lake, Q)
    results(spark, lake)
    gold, at = lake.path("gold", GOLD_TABLE), incremental.states_path(lake, "gold", GOLD_TABLE)
    assert incremental.refresh(spark, gold, at, "tpep_pickup_datetime") == 0
    # March lands again with doubled amounts, April of feed A without a valid row.
    march = raws["yellow"].where("partition_month = 3").withColumn("total_amount", F.col("total_amount") * 2)
    april = raws["yellow"].where("partition_month = 4").withColumn("total_amount", F.lit(None).cast("double"))
    ingest_bronze(spark, march.unionByName(april), FEED_A, lake)
    written = incremental.carry_months(spark, [FEED_A, FEED_B], lake, Q, ["1997-03", "1997-04"])
    assert incremental.refresh(spark, gold, at, "tpep_pickup_datetime") == 0  # the two were read by carry_months
    results(spark, lake)
    # All as if everything had been run from the new Bronze.
    other = Lake(tmp_dir + "/again", "pu_b", "pu_s", "pu_g")
    whole = {"yellow": raws["yellow"].where("partition_month NOT IN (3, 4)").unionByName(march).unionByName(april), "green": raws["green"]}
    run_all(spark, whole, specs, other, Q)
    for layer, name in (("silver", "yellow_trips"), ("gold", GOLD_TABLE), ("gold", "avg_total_amount"), ("gold", "avg_passengers")):
        mine, theirs = (spark.table(x.table(layer, name)) for x in (lake, other))
        assert mine.exceptAll(theirs).count() == 0 == theirs.exceptAll(mine).count(), name
    months = F.col("partition_month").isin(3, 4)
    assert written["gold"] == spark.table("pt_g.all_trips").where(months).count()
    assert spark.table("pt_s.yellow_trips").where("partition_month = 4").count() == 0


def test_states_of_a_removed_partition_do_not_count(spark, tmp_dir):
    path, at = f"{tmp_dir}/gold", f"{tmp_dir}/states"
    gold = layers.gold(spark, SF_SMALL, Q)
    gold.write.partitionBy("partition_year", "partition_month").parquet(path)
    n = incremental.refresh(spark, path, at, "tpep_pickup_datetime")
    assert n == gold.select("partition_year", "partition_month").distinct().count()
    left = gold.where("partition_month <> 2")
    left.write.mode("overwrite").partitionBy("partition_year", "partition_month").parquet(path)
    assert incremental.refresh(spark, path, at, "tpep_pickup_datetime") == n - 1  # every file was written again
    assert close(rows(partials.gold_summary(incremental.current_states(spark, path, at))), rows(profile.gold_summary(left)))
