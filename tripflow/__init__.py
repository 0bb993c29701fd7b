"""tripflow: a PySpark-native medallion engine for monthly trip feeds.

Raw monthly feeds are ingested into a typed Bronze layer, standardised into one
Silver schema, merged and quality-filtered into Gold, and summarised into small
result tables. Every operator is a pure ``DataFrame -> DataFrame`` function;
sinks and catalog calls live apart from the transforms.

Typical use::

    from tripflow import YELLOW, GREEN, QualitySpec, to_bronze, to_silver, consolidate
    from tripflow import avg_amount_by_month, avg_passengers_by_hour
    gold = consolidate([to_silver(to_bronze(raw_y, YELLOW), YELLOW),
                        to_silver(to_bronze(raw_g, GREEN), GREEN)], QualitySpec())
    avg_amount_by_month(gold).show()
"""

from tripflow.operators.aggregates import avg_amount_by_month, avg_passengers_by_hour
from tripflow.operators.consolidate import consolidate, quality_predicate, union_all
from tripflow.operators.ingest import cast_failures, lowercase_columns, soft_cast, to_bronze
from tripflow.operators.standardize import to_silver
from tripflow.plans.medallion import Lake, run_all
from tripflow.session import build_session
from tripflow.specs import GREEN, YELLOW, FeedSpec, QualitySpec

__version__ = "0.1.0"

__all__ = [
    "FeedSpec", "QualitySpec", "YELLOW", "GREEN", "build_session",
    "lowercase_columns", "soft_cast", "cast_failures", "to_bronze", "to_silver",
    "union_all", "quality_predicate", "consolidate", "avg_amount_by_month", "avg_passengers_by_hour",
    "Lake", "run_all",
]
