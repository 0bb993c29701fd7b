"""Silver: one schema for every feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.specs import SILVER_REQUIRED, FeedSpec


def silver_typed(bronze: DataFrame, spec: FeedSpec) -> DataFrame:
    """Select, rename, type and tag a Bronze feed (no row is removed yet).

    ``try_cast`` truncates doubles toward zero like a plain cast but turns NaN
    or out-of-range values into null instead of failing under ANSI mode.
    """
    return bronze.select(
        F.col(spec.vendor_col).try_cast("int").alias("vendor_id"),
        F.col(spec.passenger_col).try_cast("int").alias("passenger_count"),
        F.col(spec.amount_col).try_cast("double").alias("total_amount"),
        F.col(spec.pickup_col).try_cast("timestamp_ntz").alias("pickup_datetime"),
        F.col(spec.dropoff_col).try_cast("timestamp_ntz").alias("dropoff_datetime"),
        F.lit(spec.tag).alias("taxi_type"),
        F.col("partition_year").try_cast("int").alias("partition_year"),
        F.col("partition_month").try_cast("int").alias("partition_month"),
    )


def complete(df: DataFrame, columns=SILVER_REQUIRED) -> Column:
    """True when every column is non-null (and not NaN for floating columns):
    the row predicate of ``na.drop(subset=columns)``."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cond = F.lit(True)
    for c in columns:
        term = F.col(c).isNotNull()
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            term = term & ~F.isnan(F.col(c))
        cond = cond & term
    return cond


def to_silver(bronze: DataFrame, spec: FeedSpec) -> DataFrame:
    """Bronze -> Silver. Casts happen before the null filter, so a value the cast
    cannot read (NaN passengers, an id out of int range) goes with the nulls."""
    return silver_typed(bronze, spec).na.drop(subset=list(SILVER_REQUIRED))
