"""Mergeable partial states of the result tables.

A state row holds, for one partition and group, the number of rows and per measure ``n`` (non-null values), ``sum``,
``m2`` (squared distances from the group's own mean), ``min``, ``max`` and ``low`` (values of zero or less). States of the
same group merge to the state of the united rows, so a month that is replaced costs the scan of that month:
the results come from the states of all months, a few rows each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.columns import round2
from tripflow.specs import (
    AVG_PASSENGER_COUNT, AVG_TOTAL_AMOUNT, DESVIO_PADRAO, HORA, LINHAS, MAXIMO, MAX_PASSENGER, MAX_TOTAL_AMOUNT, MEDIA, MES, MINIMO,
    MIN_PASSENGER, MIN_TOTAL_AMOUNT, NEGATIVOS_OU_ZERO, PARTITION_COLUMNS, TOTAL_CORRIDAS, QualitySpec
)

MEASURES = ("total_amount", "passenger_count")
#: Groups of a trip state inside its partition: the tag and the year, month and hour of the pickup.
TRIP_GROUPS = ("taxi_type", "pickup_year", "pickup_month", "pickup_hour")


def trip_groups(df: DataFrame, pickup: str) -> DataFrame:
    """``df`` with the pickup columns of :data:`TRIP_GROUPS`."""
    return (df.withColumn("pickup_year", F.year(pickup)).withColumn("pickup_month", F.month(pickup))
            .withColumn("pickup_hour", F.hour(pickup)))


def states(df: DataFrame, by: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """One state per group of ``by``: partially aggregated before its only shuffle."""
    aggs = [F.count(F.lit(1)).alias(LINHAS)]
    for m in measures:
        aggs += [F.count(m).alias(f"{m}_n"), F.sum(m).cast("double").alias(f"{m}_sum"), (F.var_pop(m) * F.count(m)).alias(f"{m}_m2"),
                 F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"), F.count_if(F.col(m) <= 0).alias(f"{m}_low")]
    return df.groupBy(*by).agg(*aggs)


def merge(parts: DataFrame, by: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """States of the coarser groups ``by``.

    The squared distances of a part move to the common mean by ``n * (own mean - common mean)^2``. Common means are
    window sums over the same keys, so there is one shuffle, of states alone."""
    group = Window.partitionBy(*by)
    moved = parts
    for m in measures:
        mean = F.sum(f"{m}_sum").over(group) / F.nullif(F.sum(f"{m}_n").over(group), F.lit(0))
        own = F.col(f"{m}_sum") / F.nullif(F.col(f"{m}_n"), F.lit(0))
        moved = moved.withColumn(f"{m}_moved", F.col(f"{m}_m2") + F.col(f"{m}_n") * (own - mean) * (own - mean))
    aggs = [F.sum(LINHAS).alias(LINHAS)]
    for m in measures:
        aggs += [F.sum(f"{m}_n").alias(f"{m}_n"), F.sum(f"{m}_sum").alias(f"{m}_sum"), F.sum(f"{m}_moved").alias(f"{m}_m2"),
                 F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max"), F.sum(f"{m}_low").alias(f"{m}_low")]
    return moved.groupBy(*by).agg(*aggs)


def mean(measure: str) -> Column:
    return F.col(f"{measure}_sum") / F.nullif(F.col(f"{measure}_n"), F.lit(0))


def stddev(measure: str) -> Column:
    """Sample standard deviation; null for fewer than two values."""
    return F.sqrt(F.col(f"{measure}_m2") / F.nullif(F.greatest(F.col(f"{measure}_n") - 1, F.lit(0)), F.lit(0)))


# --- the result tables from states -------------------------------------------
def avg_amount_by_month(parts: DataFrame, tag: str = "yellow") -> DataFrame:
    """A1 from the states of Gold."""
    months = merge(parts.where(F.col("taxi_type") == F.lit(tag)), ["pickup_month"])
    return months.select(F.col("pickup_month").alias(MES), round2(mean("total_amount")).alias(AVG_TOTAL_AMOUNT)).orderBy(MES)


def avg_passengers_by_hour(parts: DataFrame, q: QualitySpec) -> DataFrame:
    """A2 from the states of Gold."""
    hours = merge(parts.where((F.col("pickup_year") == q.year) & (F.col("pickup_month") == q.hourly_month)), ["pickup_hour"])
    return hours.select(F.col("pickup_hour").alias(HORA), round2(mean("passenger_count")).alias(AVG_PASSENGER_COUNT)).orderBy(HORA)


def _file_month() -> list[Column]:
    return [F.col("partition_year").alias("ano"), F.col("partition_month").alias(MES)]


def amount_stats_by_month(parts: DataFrame) -> DataFrame:
    """A10 from the states of one feed's Silver."""
    m = "total_amount"
    return merge(parts, PARTITION_COLUMNS).select(
        *_file_month(), F.col(LINHAS).alias(TOTAL_CORRIDAS), round2(mean(m)).alias(MEDIA), round2(F.col(f"{m}_min")).alias(MINIMO),
        round2(F.col(f"{m}_max")).alias(MAXIMO), round2(stddev(m)).alias(DESVIO_PADRAO), F.col(f"{m}_low").alias(NEGATIVOS_OU_ZERO),
    ).orderBy("ano", MES)


def gold_summary(parts: DataFrame) -> DataFrame:
    """A11 from the states of Gold."""
    return merge(parts, ["taxi_type", *PARTITION_COLUMNS]).select(
        "taxi_type", *_file_month(), F.col(LINHAS).alias(TOTAL_CORRIDAS), round2(mean("total_amount")).alias(AVG_TOTAL_AMOUNT),
        round2(mean("passenger_count")).alias(AVG_PASSENGER_COUNT), F.col("passenger_count_min").alias(MIN_PASSENGER),
        F.col("passenger_count_max").alias(MAX_PASSENGER), F.col("total_amount_min").alias(MIN_TOTAL_AMOUNT),
        F.col("total_amount_max").alias(MAX_TOTAL_AMOUNT),
    ).orderBy("taxi_type", "ano", MES)
