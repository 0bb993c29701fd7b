"""Lazy Bronze -> Silver -> Gold chains over the shared tables.

Nothing here runs a job: each function returns a plan that Catalyst optimises
end to end (column pruning down to the table scans, filters pushed through the
union into both branches, partial aggregation before every shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.columns import month_label
from tripflow.operators.consolidate import consolidate, quality_predicate, union_all
from tripflow.operators.ingest import to_bronze
from tripflow.operators.standardize import complete, silver_typed, to_silver
from tripflow.sources.feeds import raw_feed_a, raw_feed_b
from tripflow.specs import FEED_A, FEED_B, LINHAS, MES, TESTDATA_QUALITY, FeedSpec, QualitySpec

FEEDS: dict[str, FeedSpec] = {"yellow": FEED_A, "green": FEED_B}


def raw(spark: SparkSession, sf_dir: str, tag: str) -> DataFrame:
    return raw_feed_a(spark, sf_dir) if tag == "yellow" else raw_feed_b(spark, sf_dir)


def bronze(spark: SparkSession, sf_dir: str, tag: str) -> DataFrame:
    return to_bronze(raw(spark, sf_dir, tag), FEEDS[tag])


def silver(spark: SparkSession, sf_dir: str, tag: str) -> DataFrame:
    return to_silver(bronze(spark, sf_dir, tag), FEEDS[tag])


def silver_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(silver(spark, sf_dir, "yellow"), silver(spark, sf_dir, "green"))


def gold(spark: SparkSession, sf_dir: str, q: QualitySpec = TESTDATA_QUALITY) -> DataFrame:
    return consolidate([silver(spark, sf_dir, "yellow"), silver(spark, sf_dir, "green")], q)


def layer_counts(spark: SparkSession, sf_dir: str, q: QualitySpec = TESTDATA_QUALITY) -> DataFrame:
    """(layer, feed, linhas) for Bronze, Silver and Gold in one scan per feed:
    the Silver and Gold rules are evaluated as flags and counted together."""
    frames = []
    for tag, spec in FEEDS.items():
        typed = silver_typed(bronze(spark, sf_dir, tag), spec)
        ok = complete(typed)
        kept = ok & quality_predicate(q, pickup="pickup_datetime")
        wide = typed.agg(
            F.count(F.lit(1)).alias("bronze"), F.count_if(ok).alias("silver"), F.count_if(kept).alias("gold")
        ).withColumn("feed", F.lit(tag))
        frames.append(wide.unpivot("feed", ["bronze", "silver", "gold"], "layer", LINHAS))
    return union_all(*frames).select("layer", "feed", F.col(LINHAS).cast("long").alias(LINHAS))


def volume_by_month(spark: SparkSession, sf_dir: str, q: QualitySpec = TESTDATA_QUALITY) -> DataFrame:
    """(layer, feed, mes, linhas) for Bronze and Silver inside the quality
    window's file months, in one scan per feed (Silver rows are a flag)."""
    frames = []
    for tag, spec in FEEDS.items():
        typed = silver_typed(bronze(spark, sf_dir, tag), spec).filter(
            (F.col("partition_year") == q.year) & F.col("partition_month").between(q.first_month, q.last_month)
        )
        per_month = typed.groupBy("partition_year", "partition_month").agg(
            F.count(F.lit(1)).alias("bronze"), F.count_if(complete(typed)).alias("silver")
        )
        long = per_month.select(month_label("partition_year", "partition_month").alias(MES), "bronze", "silver")
        long = long.unpivot(MES, ["bronze", "silver"], "layer", LINHAS).withColumn("feed", F.lit(tag))
        frames.append(long.filter(F.col(LINHAS) > 0))  # a month with no Silver row has no Silver group
    return union_all(*frames).select("layer", "feed", MES, F.col(LINHAS).cast("long").alias(LINHAS))
