"""Catalog operations (S6, K6-K12) through Spark SQL and ``spark.catalog``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from tripflow.specs import AVG_PASSENGER_COUNT, AVG_TOTAL_AMOUNT, HORA, MES

# Column comments of the Silver and Gold tables (documentation carried into DDL).
SILVER_DDL = (
    ("vendor_id", "int", "Provider id"),
    ("passenger_count", "int", "Passengers in the trip"),
    ("total_amount", "double", "Total amount charged"),
    ("pickup_datetime", "timestamp_ntz", "Pickup time (no zone)"),
    ("dropoff_datetime", "timestamp_ntz", "Drop-off time (no zone)"),
    ("taxi_type", "string", "Feed tag"),
)
GOLD_DDL = (
    ("VendorID", "int", "Provider id"),
    ("passenger_count", "int", "Passengers in the trip"),
    ("total_amount", "double", "Total amount charged"),
    ("tpep_pickup_datetime", "timestamp_ntz", "Pickup time (no zone)"),
    ("tpep_dropoff_datetime", "timestamp_ntz", "Drop-off time (no zone)"),
    ("taxi_type", "string", "Feed tag"),
)
MONTHLY_DDL = ((MES, "int", "Pickup month"), (AVG_TOTAL_AMOUNT, "double", "Mean total amount, 2 decimals"))
HOURLY_DDL = ((HORA, "int", "Pickup hour"), (AVG_PASSENGER_COUNT, "double", "Mean passengers, 2 decimals"))
PARTITION_DDL = (("partition_year", "int", "File year"), ("partition_month", "int", "File month"))


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_databases(spark: SparkSession, names, location_root: str | None = None) -> None:
    """K8: CREATE DATABASE IF NOT EXISTS for each name."""
    for name in names:
        loc = f" LOCATION '{location_root.rstrip('/')}/{name}.db'" if location_root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(name)}{loc}")


def create_table(
    spark: SparkSession,
    table: str,
    columns,
    location: str,
    partition_columns=(),
) -> None:
    """External Parquet table with typed, commented columns.

    ``columns``/``partition_columns`` are (name, type, comment) triples; the
    partition columns go last, as Spark stores them. A table of that name with other
    columns or another location raises."""
    cols = list(columns) + list(partition_columns)
    if spark.catalog.tableExists(table):
        check_table(spark, table, cols, location)
        return
    body = ",\n  ".join(
        f"{_q(n)} {t} COMMENT '{c.replace(chr(39), chr(39) * 2)}'" for n, t, c in cols
    )
    parts = ""
    if partition_columns:
        parts = " PARTITIONED BY (" + ", ".join(_q(n) for n, _, _ in partition_columns) + ")"
    spark.sql(
        f"CREATE TABLE {_q(table)} (\n  {body}\n) USING PARQUET{parts} LOCATION '{location}'"
    )


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _plain(location: str) -> str:
    """A location as compared: ``file:/x``, ``file:///x`` and ``/x/`` are one."""
    return re.sub(r"^file:/+", "/", location).rstrip("/")


def check_table(spark: SparkSession, table: str, columns, location: str | None = None) -> None:
    """Raise if the table differs from (name, type, comment) ``columns`` in their order, or lies elsewhere."""
    wanted = [(n.lower(), t.lower()) for n, t, _ in columns]
    held = [(c.name.lower(), c.dataType.lower()) for c in spark.catalog.listColumns(table)]
    if held != wanted:
        raise ValueError(f"{table} exists with other columns: {held}, not {wanted}")
    if location is not None and _plain(at := table_location(spark, table)) != _plain(location):
        raise ValueError(f"{table} exists at {at}, not at {location}")


def publish(spark: SparkSession, table: str, columns, location: str) -> None:
    """Let an unpartitioned table show the version at ``location``: created there, or pointed to it by one
    catalog change, so that a reader has the old version or the new one."""
    if spark.catalog.tableExists(table):
        check_table(spark, table, columns)
        spark.sql(f"ALTER TABLE {_q(table)} SET LOCATION '{location}'")
    else:
        create_table(spark, table, columns, location)
    spark.catalog.refreshTable(table)


def add_partitions(spark: SparkSession, table: str, values: list[dict[str, int]]) -> None:
    """K6 for the partitions of one write, without listing the others."""
    if values:
        parts = " ".join("PARTITION (" + ", ".join(f"{_q(k)} = {v}" for k, v in p.items()) + ")" for p in values)
        spark.sql(f"ALTER TABLE {_q(table)} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(table)


def recover_partitions(spark: SparkSession, table: str) -> None:
    """K6: make the table's partitions those of its location (new ones added, gone ones
    dropped), and drop any cached file listing of the table (a rerun replaces its files)."""
    spark.sql(f"MSCK REPAIR TABLE {_q(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def add_new_columns(spark: SparkSession, table: str, observed: T.StructType) -> list[str]:
    """K7 (merge only): add columns seen in the data but unknown to the table;
    never drop or retype a column. Returns the added names."""
    known = {c.name.lower() for c in spark.catalog.listColumns(table)}
    new = [f for f in observed.fields if f.name.lower() not in known]
    if new:
        cols = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {_q(table)} ADD COLUMNS ({cols})")
    return [f.name for f in new]


def register_discovered(
    spark: SparkSession, table: str, location: str, partition_columns=("partition_year", "partition_month"),
    schema: T.StructType | None = None, written: list[dict[str, int]] | None = None,
) -> list[str]:
    """K7: the crawler's effect. Discover the data schema under ``location``
    (footers only, merged across all files in a distributed job, so a column that
    only newer files carry is found), create the table if it is new, otherwise
    merge new columns; then register partitions. Returns the columns added to an
    existing table. Bronze files share one typed schema (the soft cast), so the
    footer merge never meets conflicting types."""
    # ``written``: the partitions of this write; a table that exists gets these alone, without a listing of all.
    # A writer that just wrote the folder passes its own schema; no footer is read then.
    data_schema = schema or spark.read.option("mergeSchema", "true").parquet(location).schema
    parts = set(partition_columns)
    data_fields = [f for f in data_schema.fields if f.name not in parts]
    if not spark.catalog.tableExists(table):
        cols = [(f.name, f.dataType.simpleString(), "discovered") for f in data_fields]
        pcols = [(f.name, f.dataType.simpleString(), "partition") for f in data_schema.fields if f.name in parts]
        create_table(spark, table, cols, location, pcols)
        added: list[str] = []
    else:
        if _plain(at := table_location(spark, table)) != _plain(location):
            raise ValueError(f"{table} exists at {at}, not at {location}")
        added = add_new_columns(spark, table, T.StructType(data_fields))
        if written is not None:
            add_partitions(spark, table, written)
            return added
    if partition_columns:
        recover_partitions(spark, table)
    return added


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """(name, database, tableType) of a database."""
    rows = [(t.name, t.database or database, t.tableType) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, database string, tableType string")


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    """(name, dataType, isPartition, description) of a table."""
    rows = [(c.name, c.dataType, c.isPartition, c.description) for c in spark.catalog.listColumns(table)]
    return spark.createDataFrame(rows, "name string, dataType string, isPartition boolean, description string")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Catalog table scan."""
    return spark.table(table)
