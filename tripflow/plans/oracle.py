"""DuckDB SQL that states, independently of the Spark code, what each registered
query must return. Used by ``__spark_entry__.oracle_sql`` and by the tests.

The oracles follow the reference's own formulation (YEAR()/MONTH() predicates,
one SELECT per column, ...), so they also check our rewrites (time ranges,
one-pass profiles). Spark's ROUND is HALF_UP on the decimal value, which DuckDB
reproduces by rounding the decimal form of the double (see :func:`r2`).
"""

from __future__ import annotations

from tripflow.specs import TESTDATA_QUALITY


def r2(expr: str) -> str:
    """Spark ROUND(x, 2) in DuckDB: round the decimal value half-up."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    """part*100/whole rounded half-up to 2 decimals with exact integer arithmetic."""
    num = f"(CAST({part} AS BIGINT) * 20000 + CAST({whole} AS BIGINT))"
    den = f"(CAST({whole} AS BIGINT) * 2)"
    return f"(CASE WHEN {whole} > 0 THEN CAST({num} // {den} AS DOUBLE) / 100.0 ELSE 0.0 END)"


Q = TESTDATA_QUALITY

# Fixed feed definitions in the DuckDB dialect (timestampadd -> + to_seconds).
FEED_CTES = f"""
raw_a AS (
  SELECT l_suppkey AS VendorID,
         l_shipdate + to_seconds((l_orderkey*7919)%259200) AS tpep_pickup_datetime,
         l_shipdate + to_seconds((l_orderkey*7919)%259200 + CAST(l_quantity AS INT)*60) AS tpep_dropoff_datetime,
         CASE WHEN l_quantity >= 46 THEN NULL ELSE l_linenumber + l_quantity%2 - 1 END AS passenger_count,
         CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS total_amount,
         year(l_shipdate) AS partition_year, month(l_shipdate) AS partition_month
  FROM lineitem),
raw_b AS (
  SELECT o_custkey AS VendorID,
         o_orderdate + to_seconds((o_orderkey*104729)%86400) AS lpep_pickup_datetime,
         o_orderdate + to_seconds((o_orderkey*104729)%86400 + 600) AS lpep_dropoff_datetime,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(o_orderkey%8 AS DOUBLE) END AS passenger_count,
         CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS total_amount,
         year(o_orderdate) AS partition_year, month(o_orderdate) AS partition_month
  FROM orders),
bronze_a AS (
  SELECT CAST(VendorID AS BIGINT) AS vendorid,
         CAST(tpep_pickup_datetime AS TIMESTAMP) AS tpep_pickup_datetime,
         CAST(tpep_dropoff_datetime AS TIMESTAMP) AS tpep_dropoff_datetime,
         CAST(passenger_count AS DOUBLE) AS passenger_count,
         CAST(total_amount AS DOUBLE) AS total_amount,
         CAST(partition_year AS INTEGER) AS partition_year,
         CAST(partition_month AS INTEGER) AS partition_month
  FROM raw_a),
bronze_b AS (
  SELECT CAST(VendorID AS BIGINT) AS vendorid,
         CAST(lpep_pickup_datetime AS TIMESTAMP) AS lpep_pickup_datetime,
         CAST(lpep_dropoff_datetime AS TIMESTAMP) AS lpep_dropoff_datetime,
         CAST(passenger_count AS DOUBLE) AS passenger_count,
         CAST(total_amount AS DOUBLE) AS total_amount,
         CAST(partition_year AS INTEGER) AS partition_year,
         CAST(partition_month AS INTEGER) AS partition_month
  FROM raw_b),
typed_a AS (
  SELECT TRY_CAST(vendorid AS INTEGER) AS vendor_id,
         TRY_CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
         CAST(total_amount AS DOUBLE) AS total_amount,
         tpep_pickup_datetime AS pickup_datetime,
         tpep_dropoff_datetime AS dropoff_datetime,
         'yellow' AS taxi_type, partition_year, partition_month
  FROM bronze_a),
typed_b AS (
  SELECT TRY_CAST(vendorid AS INTEGER) AS vendor_id,
         TRY_CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
         CAST(total_amount AS DOUBLE) AS total_amount,
         lpep_pickup_datetime AS pickup_datetime,
         lpep_dropoff_datetime AS dropoff_datetime,
         'green' AS taxi_type, partition_year, partition_month
  FROM bronze_b),
silver_a AS (
  SELECT * FROM typed_a
  WHERE vendor_id IS NOT NULL AND passenger_count IS NOT NULL AND total_amount IS NOT NULL
    AND NOT isnan(total_amount) AND pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL),
silver_b AS (
  SELECT * FROM typed_b
  WHERE vendor_id IS NOT NULL AND passenger_count IS NOT NULL AND total_amount IS NOT NULL
    AND NOT isnan(total_amount) AND pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL),
silver_all AS (SELECT * FROM silver_a UNION ALL SELECT * FROM silver_b),
gold AS (
  SELECT vendor_id AS VendorID, passenger_count, total_amount,
         pickup_datetime AS tpep_pickup_datetime, dropoff_datetime AS tpep_dropoff_datetime,
         taxi_type, partition_year, partition_month
  FROM silver_all
  WHERE year(pickup_datetime) = {Q.year}
    AND month(pickup_datetime) BETWEEN {Q.first_month} AND {Q.last_month}
    AND total_amount > {Q.min_amount} AND passenger_count > {Q.min_passengers}
    AND passenger_count <= {Q.max_passengers})
"""


def with_feeds(body: str) -> str:
    return f"WITH {FEED_CTES.strip()}\n{body.strip()}"


ORACLES: dict[str, str] = {}

ORACLES["avg_amount_by_month"] = with_feeds(f"""
SELECT CAST(month(tpep_pickup_datetime) AS INTEGER) AS mes,
       {r2('avg(total_amount)')} AS avg_total_amount
FROM gold WHERE taxi_type = '{Q.monthly_tag}'
GROUP BY 1 ORDER BY 1
""")

ORACLES["avg_passengers_by_hour"] = with_feeds(f"""
SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hora,
       {r2('avg(passenger_count)')} AS avg_passenger_count
FROM gold WHERE month(tpep_pickup_datetime) = {Q.hourly_month}
GROUP BY 1 ORDER BY 1
""")

# --- row-level layers ---------------------------------------------------------
ORACLES["bronze_feed_a"] = with_feeds("SELECT * FROM bronze_a")
ORACLES["bronze_feed_b"] = with_feeds("SELECT * FROM bronze_b")
ORACLES["silver_feed_a"] = with_feeds("SELECT * FROM silver_a")
ORACLES["silver_feed_b"] = with_feeds("SELECT * FROM silver_b")
ORACLES["gold_all"] = with_feeds("SELECT * FROM gold")
ORACLES["union_all"] = with_feeds("SELECT taxi_type, count(*) AS linhas FROM silver_all GROUP BY taxi_type")

# --- SQL forms: same answers as the DataFrame forms -----------------------------
ORACLES["q1_sql"] = ORACLES["avg_amount_by_month"]
ORACLES["q2_sql"] = ORACLES["avg_passengers_by_hour"]

# --- profiles -------------------------------------------------------------------
ORACLES["layer_counts"] = with_feeds("""
SELECT 'bronze' AS layer, 'yellow' AS feed, count(*) AS linhas FROM bronze_a
UNION ALL SELECT 'silver', 'yellow', count(*) FROM silver_a
UNION ALL SELECT 'gold', 'yellow', count(*) FROM gold WHERE taxi_type = 'yellow'
UNION ALL SELECT 'bronze', 'green', count(*) FROM bronze_b
UNION ALL SELECT 'silver', 'green', count(*) FROM silver_b
UNION ALL SELECT 'gold', 'green', count(*) FROM gold WHERE taxi_type = 'green'
""")


def _volume(layer: str, feed: str, table: str) -> str:
    return (f"SELECT '{layer}' AS layer, '{feed}' AS feed, "
            f"printf('%04d-%02d', partition_year, partition_month) AS mes, count(*) AS linhas "
            f"FROM {table} WHERE partition_year = {Q.year} "
            f"AND partition_month BETWEEN {Q.first_month} AND {Q.last_month} "
            f"GROUP BY partition_year, partition_month")


ORACLES["volume_by_month"] = with_feeds("\nUNION ALL\n".join([
    _volume("bronze", "yellow", "bronze_a"), _volume("bronze", "green", "bronze_b"),
    _volume("silver", "yellow", "silver_a"), _volume("silver", "green", "silver_b"),
]))

ORACLES["partition_counts"] = with_feeds("""
SELECT 'yellow' AS feed, partition_year, partition_month, count(*) AS total_linhas
FROM bronze_a GROUP BY partition_year, partition_month
UNION ALL
SELECT 'green' AS feed, partition_year, partition_month, count(*) AS total_linhas
FROM bronze_b GROUP BY partition_year, partition_month
ORDER BY feed, partition_year, partition_month
""")


def _null_profile(table: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        parts.append(
            f"SELECT '{c}' AS coluna, count(*) AS total, count(*) - count({c}) AS nulos, "
            f"{pct(f'count(*) - count({c})', 'count(*)')} AS pct_nulos FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


ORACLES["null_profile_a"] = with_feeds(_null_profile(
    "bronze_a", ["vendorid", "passenger_count", "total_amount", "tpep_pickup_datetime", "tpep_dropoff_datetime"]))
ORACLES["null_profile_b"] = with_feeds(_null_profile(
    "bronze_b", ["vendorid", "passenger_count", "total_amount", "lpep_pickup_datetime", "lpep_dropoff_datetime"]))

# Spark type names of the raw feed columns (what schema_profile must report).
_RAW_TYPES = {
    "VendorID": "bigint", "passenger_count": "double", "total_amount": "double",
    "partition_year": "int", "partition_month": "int",
}


def _schema_profile(feed: str, table: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        kind = _RAW_TYPES.get(c, "timestamp_ntz")
        parts.append(
            f"SELECT '{feed}' AS feed, '{c}' AS coluna, '{kind}' AS tipo, count(*) - count({c}) AS nulos, "
            f"{pct(f'count(*) - count({c})', 'count(*)')} AS pct_nulos FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


ORACLES["schema_profile"] = with_feeds("\nUNION ALL\n".join([
    _schema_profile("yellow", "raw_a", ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                                        "passenger_count", "total_amount", "partition_year", "partition_month"]),
    _schema_profile("green", "raw_b", ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime",
                                       "passenger_count", "total_amount", "partition_year", "partition_month"]),
]))

ORACLES["passenger_distribution"] = with_feeds(f"""
, dist AS (SELECT taxi_type, passenger_count, count(*) AS total FROM silver_all GROUP BY taxi_type, passenger_count)
SELECT taxi_type, passenger_count, total,
       {pct('total', 'sum(total) OVER (PARTITION BY taxi_type)')} AS pct
FROM dist ORDER BY taxi_type, passenger_count
""".replace("\n, dist", ",\ndist", 1))

ORACLES["amount_stats_by_month"] = with_feeds(f"""
SELECT partition_year AS ano, partition_month AS mes,
       count(*) AS total_corridas,
       {r2('avg(total_amount)')} AS media,
       {r2('min(total_amount)')} AS minimo,
       {r2('max(total_amount)')} AS maximo,
       {r2('stddev_samp(total_amount)')} AS desvio_padrao,
       CAST(sum(CASE WHEN total_amount <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS negativos_ou_zero
FROM silver_a
GROUP BY partition_year, partition_month
ORDER BY ano, mes
""")

ORACLES["gold_summary"] = with_feeds(f"""
SELECT taxi_type, partition_year AS ano, partition_month AS mes,
       count(*) AS total_corridas,
       {r2('avg(total_amount)')} AS avg_total_amount,
       {r2('avg(passenger_count)')} AS avg_passenger_count,
       min(passenger_count) AS min_passenger,
       max(passenger_count) AS max_passenger,
       min(total_amount) AS min_total_amount,
       max(total_amount) AS max_total_amount
FROM gold
GROUP BY taxi_type, partition_year, partition_month
ORDER BY taxi_type, ano, mes
""")


def _audit(stage: str, table: str, pickup: str) -> str:
    return f"""
SELECT '{stage}' AS stage,
       CAST(sum(CASE WHEN total_amount <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS total_amount_invalido,
       CAST(sum(CASE WHEN passenger_count <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS passenger_count_zero,
       CAST(sum(CASE WHEN passenger_count > 6 THEN 1 ELSE 0 END) AS BIGINT) AS passenger_count_acima_6,
       CAST(sum(CASE WHEN year({pickup}) != {Q.year} THEN 1 ELSE 0 END) AS BIGINT) AS ano_invalido,
       CAST(sum(CASE WHEN month({pickup}) NOT BETWEEN {Q.first_month} AND {Q.last_month}
                THEN 1 ELSE 0 END) AS BIGINT) AS mes_invalido,
       count(*) AS total
FROM {table}"""


ORACLES["filter_audit"] = with_feeds(
    _audit("silver", "silver_all", "pickup_datetime") + "\nUNION ALL" + _audit("gold", "gold", "tpep_pickup_datetime")
)

ORACLES["sample_month"] = with_feeds(f"""
SELECT * FROM gold
WHERE partition_year = {Q.year} AND partition_month = {Q.first_month}
ORDER BY VendorID NULLS FIRST, passenger_count NULLS FIRST, total_amount NULLS FIRST,
         tpep_pickup_datetime NULLS FIRST, tpep_dropoff_datetime NULLS FIRST, taxi_type NULLS FIRST,
         partition_year NULLS FIRST, partition_month NULLS FIRST
LIMIT 5
""")

# --- ingest and schema audits -----------------------------------------------------
_RAW_B_TEXT = """
raw_b_text AS (
  SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS vendorid,
         o_orderdate + to_seconds((o_orderkey*104729)%86400) AS lpep_pickup_datetime,
         o_orderdate + to_seconds((o_orderkey*104729)%86400 + 600) AS lpep_dropoff_datetime,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(o_orderkey%8 AS DOUBLE) END AS passenger_count,
         CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS total_amount
  FROM orders)"""


def _failures(feed: str, table: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for c, kind in cols:
        parts.append(
            f"SELECT '{feed}' AS feed, '{c}' AS coluna, "
            f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {kind}) IS NULL) AS falhas FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


ORACLES["cast_failures"] = (
    f"WITH {FEED_CTES.strip()},{_RAW_B_TEXT}\n"
    + _failures("yellow", "bronze_a", [("vendorid", "BIGINT"), ("tpep_pickup_datetime", "TIMESTAMP"),
                                       ("tpep_dropoff_datetime", "TIMESTAMP"), ("passenger_count", "DOUBLE"),
                                       ("total_amount", "DOUBLE")])
    + "\nUNION ALL\n"
    + _failures("green", "raw_b_text", [("vendorid", "BIGINT"), ("lpep_pickup_datetime", "TIMESTAMP"),
                                        ("lpep_dropoff_datetime", "TIMESTAMP"), ("passenger_count", "DOUBLE"),
                                        ("total_amount", "DOUBLE")])
)


ORACLES["cast_quarantine"] = """
SELECT 'green' AS feed, 'vendorid' AS coluna, 'bigint' AS tipo, 'x' AS valor,
       CAST(year(o_orderdate) AS INTEGER) AS partition_year, CAST(month(o_orderdate) AS INTEGER) AS partition_month, count(*) AS vezes
FROM orders WHERE o_orderkey % 10 = 0 GROUP BY year(o_orderdate), month(o_orderdate)
"""

ORACLES["bronze_column_cast"] = f"WITH {FEED_CTES.strip()}\n" + """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS vendorid,
       CAST(o_orderdate + to_seconds((o_orderkey*104729)%86400) AS TIMESTAMP) AS lpep_pickup_datetime,
       CAST(o_orderdate + to_seconds((o_orderkey*104729)%86400 + 600) AS TIMESTAMP) AS lpep_dropoff_datetime,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(o_orderkey%8 AS DOUBLE) END AS passenger_count,
       CAST(CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS DOUBLE) AS total_amount,
       CAST(year(o_orderdate) AS INTEGER) AS partition_year, CAST(month(o_orderdate) AS INTEGER) AS partition_month
FROM orders
"""


def _required(feed: str, table: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for c, kind in cols:
        parts.append(f"SELECT '{feed}' AS feed, '{c}' AS coluna, true AS presente, '{kind}' AS tipo, "
                     f"count({c}) AS nao_nulos FROM {table}")
    return "\nUNION ALL\n".join(parts)


ORACLES["required_columns"] = with_feeds(
    _required("yellow", "raw_a", [("VendorID", "bigint"), ("passenger_count", "double"), ("total_amount", "double"),
                                  ("tpep_pickup_datetime", "timestamp_ntz"), ("tpep_dropoff_datetime", "timestamp_ntz")])
    + "\nUNION ALL\n"
    + _required("green", "raw_b", [("VendorID", "bigint"), ("passenger_count", "double"), ("total_amount", "double"),
                                   ("lpep_pickup_datetime", "timestamp_ntz"), ("lpep_dropoff_datetime", "timestamp_ntz")])
)

_EXPECTED_MONTHS = """
expected AS (
  SELECT strftime(m, '%Y-%m') AS mes
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH) AS t(m))"""

ORACLES["missing_months"] = f"WITH {FEED_CTES.strip()},{_EXPECTED_MONTHS}\n" + """
SELECT 'yellow' AS feed, mes FROM expected
WHERE mes NOT IN (SELECT printf('%04d-%02d', partition_year, partition_month) FROM bronze_a)
UNION ALL
SELECT 'green' AS feed, mes FROM expected
WHERE mes NOT IN (SELECT printf('%04d-%02d', partition_year, partition_month) FROM bronze_b)
"""


ORACLES["ingest_status"] = f"WITH {FEED_CTES.strip()},{_EXPECTED_MONTHS}\n" + """
, counts AS (
  SELECT 'yellow' AS feed, printf('%04d-%02d', partition_year, partition_month) AS mes, count(*) AS linhas
  FROM raw_a GROUP BY 1, 2
  UNION ALL
  SELECT 'green', printf('%04d-%02d', partition_year, partition_month), count(*) FROM raw_b GROUP BY 1, 2),
feeds AS (SELECT * FROM (VALUES ('yellow', 'yellow_tripdata'), ('green', 'green_tripdata')) AS f(feed, prefix))
SELECT f.feed, e.mes,
       CASE WHEN c.linhas IS NULL THEN 'missing' ELSE 'ok' END AS status,
       COALESCE(c.linhas, 0) AS linhas,
       CASE WHEN c.linhas IS NULL THEN 'no file for ' || f.prefix || '_' || e.mes END AS erro
FROM feeds f CROSS JOIN expected e
LEFT JOIN counts c ON c.feed = f.feed AND c.mes = e.mes
""".replace("\n, counts", ",\ncounts", 1)


ORACLES["file_volume"] = with_feeds("""
SELECT 'yellow' AS feed, printf('%04d-%02d', partition_year, partition_month) AS mes, count(*) AS linhas, 5 AS colunas, true AS tem_tamanho
FROM bronze_a GROUP BY 1, 2
UNION ALL
SELECT 'green', printf('%04d-%02d', partition_year, partition_month), count(*), 5, true FROM bronze_b GROUP BY 1, 2
""")
ORACLES["landed_columns"] = with_feeds("""
, months AS (
  SELECT 'yellow' AS feed, 't' AS letter, printf('%04d-%02d', partition_year, partition_month) AS mes, count(*) AS linhas FROM raw_a GROUP BY 3
  UNION ALL
  SELECT 'green', 'l', printf('%04d-%02d', partition_year, partition_month), count(*) FROM raw_b GROUP BY 3),
columns AS (SELECT * FROM (VALUES ('VendorID', 'bigint'), ('?pep_pickup_datetime', 'timestamp_ntz'), ('?pep_dropoff_datetime', 'timestamp_ntz'),
                                  ('passenger_count', 'double'), ('total_amount', 'double')) AS c(name, tipo))
SELECT feed, mes, replace(name, '?', letter) AS coluna, tipo, linhas FROM months CROSS JOIN columns
""").replace("\n, months", ",\nmonths", 1)
ORACLES["landing_scan"] = with_feeds("""
SELECT 'yellow' AS feed, vendorid, passenger_count, total_amount, partition_year, partition_month FROM bronze_a
UNION ALL
SELECT 'green' AS feed, vendorid, passenger_count, total_amount, partition_year, partition_month FROM bronze_b
""")
ORACLES["lake_avg_amount_by_month"] = ORACLES["avg_amount_by_month"]
ORACLES["lake_avg_passengers_by_hour"] = ORACLES["avg_passengers_by_hour"]
ORACLES["lake_gold_summary"] = ORACLES["gold_summary"]
ORACLES["stream_partition_counts"] = ORACLES["partition_counts"]
ORACLES["stored_partition_counts"] = ORACLES["partition_counts"]


def _null_profile_of(feed: str, table: str, columns: list[str]) -> str:
    return f"SELECT '{feed}' AS feed, * FROM ({_null_profile(table, columns)})"


ORACLES["stored_null_profile"] = with_feeds(
    _null_profile_of("yellow", "bronze_a", ["vendorid", "passenger_count", "total_amount", "tpep_pickup_datetime", "tpep_dropoff_datetime"])
    + "\nUNION ALL\n"
    + _null_profile_of("green", "bronze_b", ["vendorid", "passenger_count", "total_amount", "lpep_pickup_datetime", "lpep_dropoff_datetime"]))
ORACLES["states_avg_amount_by_month"] = ORACLES["avg_amount_by_month"]
ORACLES["states_avg_passengers_by_hour"] = ORACLES["avg_passengers_by_hour"]
ORACLES["states_gold_summary"] = ORACLES["gold_summary"]
ORACLES["states_amount_stats_by_month"] = ORACLES["amount_stats_by_month"]
