"""Gold: union of the Silver feeds and the quality filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.columns import in_range
from tripflow.specs import QualitySpec


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a missing column is an error (strict)."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b), frames)


def gold_projection(df: DataFrame) -> DataFrame:
    """Silver names -> Gold names and types."""
    return df.select(
        F.col("vendor_id").cast("int").alias("VendorID"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"),
        F.col("taxi_type").cast("string").alias("taxi_type"),
        F.col("partition_year").cast("int").alias("partition_year"),
        F.col("partition_month").cast("int").alias("partition_month"),
    )


def quality_predicate(
    q: QualitySpec,
    pickup: str = "tpep_pickup_datetime",
    amount: str = "total_amount",
    passengers: str = "passenger_count",
) -> Column:
    """YEAR/MONTH window as a pushable half-open time range, plus value rules."""
    start, end = q.window()
    return (
        in_range(pickup, start, end)
        & (F.col(amount) > F.lit(q.min_amount))
        & (F.col(passengers) > F.lit(q.min_passengers))
        & (F.col(passengers) <= F.lit(q.max_passengers))
    )


def to_gold(silver_union: DataFrame, q: QualitySpec) -> DataFrame:
    return gold_projection(silver_union).filter(quality_predicate(q))


def consolidate(silvers: list[DataFrame], q: QualitySpec) -> DataFrame:
    """J3 transform: union, rename, filter. The filters sit above the union and
    Catalyst pushes them into every branch (and into every scan)."""
    return to_gold(union_all(*silvers), q)
