"""The two raw monthly feeds derived from the shared tables.

Feed A (tag yellow) comes from ``lineitem`` and feed B (tag green) from
``orders``. They carry nulls, refunds (negative amounts), 0 and 7 passengers,
times over the whole day and a file month (``partition_*``) that can differ
from the pickup month. The SQL below is the fixed feed definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.sources.tables import read_table

# Fixed feed definitions (Spark SQL dialect).
RAW_A_SQL = """
SELECT l_suppkey AS VendorID,
       timestampadd(SECOND, (l_orderkey*7919)%259200, l_shipdate) AS tpep_pickup_datetime,
       timestampadd(SECOND, (l_orderkey*7919)%259200 + CAST(l_quantity AS INT)*60, l_shipdate) AS tpep_dropoff_datetime,
       CASE WHEN l_quantity >= 46 THEN NULL ELSE l_linenumber + l_quantity%2 - 1 END AS passenger_count,
       CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS total_amount,
       year(l_shipdate) AS partition_year, month(l_shipdate) AS partition_month
FROM {lineitem}
"""

RAW_B_SQL = """
SELECT o_custkey AS VendorID,
       timestampadd(SECOND, (o_orderkey*104729)%86400, o_orderdate) AS lpep_pickup_datetime,
       timestampadd(SECOND, (o_orderkey*104729)%86400 + 600, o_orderdate) AS lpep_dropoff_datetime,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(o_orderkey%8 AS DOUBLE) END AS passenger_count,
       CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS total_amount,
       year(o_orderdate) AS partition_year, month(o_orderdate) AS partition_month
FROM {orders}
"""

# Feed B with the vendor id delivered as text, one id in ten unreadable: the
# input of the soft-cast failure report (a string column with bad values).
RAW_B_TEXT_VENDOR_SQL = """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END AS VendorID,
       timestampadd(SECOND, (o_orderkey*104729)%86400, o_orderdate) AS lpep_pickup_datetime,
       timestampadd(SECOND, (o_orderkey*104729)%86400 + 600, o_orderdate) AS lpep_dropoff_datetime,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(o_orderkey%8 AS DOUBLE) END AS passenger_count,
       CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS total_amount,
       year(o_orderdate) AS partition_year, month(o_orderdate) AS partition_month
FROM {orders}
"""


def raw_feed_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_A_SQL, lineitem=read_table(spark, sf_dir, "lineitem"))


def raw_feed_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_B_SQL, orders=read_table(spark, sf_dir, "orders"))


def raw_feed_b_text_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_B_TEXT_VENDOR_SQL, orders=read_table(spark, sf_dir, "orders"))


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tag -> raw feed."""
    return {"yellow": raw_feed_a(spark, sf_dir), "green": raw_feed_b(spark, sf_dir)}
