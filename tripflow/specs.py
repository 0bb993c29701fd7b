"""Feeds and quality rules as data: a new feed needs a spec, not new code."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (column names, types, tags,
# months and quality thresholds of the two monthly trip feeds).
# ---------------------------------------------------------------------------
YELLOW_BRONZE_TYPES = (
    ("vendorid", "bigint"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("ratecodeid", "double"),
    ("store_and_fwd_flag", "string"),
    ("pulocationid", "bigint"),
    ("dolocationid", "bigint"),
    ("payment_type", "bigint"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("airport_fee", "double"),
)
GREEN_BRONZE_TYPES = (
    ("vendorid", "bigint"),
    ("lpep_pickup_datetime", "timestamp_ntz"),
    ("lpep_dropoff_datetime", "timestamp_ntz"),
    ("store_and_fwd_flag", "string"),
    ("ratecodeid", "double"),
    ("pulocationid", "bigint"),
    ("dolocationid", "bigint"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("ehail_fee", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("payment_type", "double"),
    ("trip_type", "double"),
    ("congestion_surcharge", "double"),
)
SILVER_REQUIRED = ("vendor_id", "passenger_count", "total_amount", "pickup_datetime", "dropoff_datetime")
SILVER_COLUMNS = (
    "vendor_id", "passenger_count", "total_amount", "pickup_datetime", "dropoff_datetime",
    "taxi_type", "partition_year", "partition_month",
)
GOLD_COLUMNS = (
    "VendorID", "passenger_count", "total_amount", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "taxi_type", "partition_year", "partition_month",
)
PARTITION_COLUMNS = ("partition_year", "partition_month")
REFERENCE_MONTHS = ("2023-01", "2023-02", "2023-03", "2023-04", "2023-05")
REFERENCE_YEAR, REFERENCE_FIRST_MONTH, REFERENCE_LAST_MONTH = 2023, 1, 5
MAX_PASSENGERS = 6
# Databases and tables of the catalog.
DATABASES = ("trip_bronze", "trip_silver", "trip_gold")

# Output column names of the result tables and of the exploratory queries,
# grouped by the query that names them, in the order it selects them.
MES, AVG_TOTAL_AMOUNT = "mes", "avg_total_amount"                    # monthly mean
HORA, AVG_PASSENGER_COUNT = "hora", "avg_passenger_count"            # hourly mean
TABELA, LINHAS, COLUNAS, TAMANHO_MB = "tabela", "linhas", "colunas", "tamanho_mb"  # volumes
AUSENTE = "AUSENTE"                                                  # drift matrix: absent column
COLUNA, TIPO, NULOS, PCT_NULOS = "coluna", "tipo", "nulos", "pct_nulos"  # schema profile
PRESENTE = "presente"                                                # required columns
TOTAL, NAO_NULOS = "total", "nao_nulos"                              # null profile (+ COLUNA, NULOS, PCT_NULOS)
PCT = "pct"                                                          # value distribution (+ TOTAL)
TOTAL_CORRIDAS, MEDIA, MINIMO, MAXIMO, DESVIO_PADRAO, NEGATIVOS_OU_ZERO = (
    "total_corridas", "media", "minimo", "maximo", "desvio_padrao", "negativos_ou_zero")  # amount stats
MIN_PASSENGER, MAX_PASSENGER, MIN_TOTAL_AMOUNT, MAX_TOTAL_AMOUNT = (
    "min_passenger", "max_passenger", "min_total_amount", "max_total_amount")  # Gold summary
TOTAL_AMOUNT_INVALIDO, PASSENGER_COUNT_ZERO, PASSENGER_COUNT_ACIMA_6, ANO_INVALIDO, MES_INVALIDO = (
    "total_amount_invalido", "passenger_count_zero", "passenger_count_acima_6", "ano_invalido", "mes_invalido")  # audit
TOTAL_LINHAS = "total_linhas"                                        # rows per partition
SUCESSOS, FALHAS = "sucessos", "falhas"                              # ingest tally
# ---------------------------------------------------------------------------


def month_range(first: str, last: str) -> tuple[str, ...]:
    """Inclusive list of 'YYYY-MM' labels (calendar sized, never data sized)."""
    y, m = (int(p) for p in first.split("-"))
    ly, lm = (int(p) for p in last.split("-"))
    out = []
    while (y, m) <= (ly, lm):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return tuple(out)


@dataclass(frozen=True)
class FeedSpec:
    """One monthly feed: its tag, landing file prefix and typed Bronze schema."""

    tag: str
    prefix: str
    bronze_types: tuple[tuple[str, str], ...]
    pickup_col: str
    dropoff_col: str
    vendor_col: str = "vendorid"
    passenger_col: str = "passenger_count"
    amount_col: str = "total_amount"
    months: tuple[str, ...] = REFERENCE_MONTHS
    # Raw (source) spelling of the required columns, used by the source audit.
    raw_required: tuple[str, ...] = field(default=())

    @property
    def bronze_schema(self) -> T.StructType:
        """Widest read schema: every known column, lower-case, nullable."""
        return T.StructType(
            [T.StructField(name, T._parse_datatype_string(kind), True) for name, kind in self.bronze_types]
        )

    @property
    def bronze_required(self) -> tuple[str, ...]:
        return (self.vendor_col, self.passenger_col, self.amount_col, self.pickup_col, self.dropoff_col)

    def with_months(self, first: str, last: str) -> "FeedSpec":
        return replace(self, months=month_range(first, last))


@dataclass(frozen=True)
class QualitySpec:
    """Gold quality window and thresholds.

    Rows are kept when the pickup lies in ``year`` between ``first_month`` and
    ``last_month`` (inclusive), ``total_amount > min_amount`` and
    ``min_passengers < passenger_count <= max_passengers``.
    """

    year: int = REFERENCE_YEAR
    first_month: int = REFERENCE_FIRST_MONTH
    last_month: int = REFERENCE_LAST_MONTH
    min_amount: float = 0.0
    min_passengers: int = 0
    max_passengers: int = MAX_PASSENGERS
    hourly_month: int = REFERENCE_LAST_MONTH
    monthly_tag: str = "yellow"

    def window(self) -> tuple[date, date]:
        """Half-open [start, end) pickup range equivalent to YEAR = y AND MONTH BETWEEN a AND b."""
        start = date(self.year, self.first_month, 1)
        end = date(self.year + 1, 1, 1) if self.last_month == 12 else date(self.year, self.last_month + 1, 1)
        return start, end

    def month_window(self, month: int) -> tuple[date, date]:
        start = date(self.year, month, 1)
        end = date(self.year + 1, 1, 1) if month == 12 else date(self.year, month + 1, 1)
        return start, end


YELLOW = FeedSpec(
    tag="yellow",
    prefix="yellow_tripdata",
    bronze_types=YELLOW_BRONZE_TYPES,
    pickup_col="tpep_pickup_datetime",
    dropoff_col="tpep_dropoff_datetime",
    raw_required=("VendorID", "passenger_count", "total_amount", "tpep_pickup_datetime", "tpep_dropoff_datetime"),
)
GREEN = FeedSpec(
    tag="green",
    prefix="green_tripdata",
    bronze_types=GREEN_BRONZE_TYPES,
    pickup_col="lpep_pickup_datetime",
    dropoff_col="lpep_dropoff_datetime",
    raw_required=("VendorID", "passenger_count", "total_amount", "lpep_pickup_datetime", "lpep_dropoff_datetime"),
)
REFERENCE_QUALITY = QualitySpec()

# The two feeds derived from /root/testdata (FIXTURES.md part 2): feed A from
# lineitem (tag yellow), feed B from orders (tag green); their dates run from
# 1995 to 2001 and the quality window is 1997, months 1-5.
FEED_A = YELLOW.with_months("1995-01", "2001-12")
FEED_B = GREEN.with_months("1995-01", "2001-12")
TESTDATA_QUALITY = QualitySpec(year=1997, first_month=1, last_month=5, hourly_month=5)
