"""Scalar column helpers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: date | datetime | str) -> Column:
    """A timestamp_ntz literal. It folds to a constant, so comparisons against it
    reach the Parquet reader as pushed filters whatever the session zone is."""
    if isinstance(value, datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")


def in_range(col: str | Column, start, end) -> Column:
    """Half-open range ``start <= col < end``.

    This is how YEAR(ts) = y AND MONTH(ts) BETWEEN a AND b is expressed: the two
    comparisons are pushed to the scan (row-group and file skipping), whereas
    year()/month() would stay a residual filter.
    """
    c = F.col(col) if isinstance(col, str) else col
    return (c >= ntz(start)) & (c < ntz(end))


def round2(col: str | Column) -> Column:
    """ROUND(x, 2) with Spark's HALF_UP on the decimal value."""
    return F.round(F.col(col) if isinstance(col, str) else col, 2)


def pct_half_up(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """``part * 100 / whole`` rounded half-up to ``digits`` decimals, 0 when whole = 0.

    Exact integer arithmetic: the quotient is computed as an integer number of
    10^-digits units, so no binary rounding of the ratio can move a tie.
    """
    p = F.col(part) if isinstance(part, str) else part
    w = F.col(whole) if isinstance(whole, str) else whole
    scale = 10 ** (digits + 2)
    num = p.cast("long") * F.lit(2 * scale) + w.cast("long")
    den = w.cast("long") * F.lit(2)
    units = (num - F.pmod(num, den)) / den
    return F.when(w > 0, units / F.lit(float(10**digits))).otherwise(F.lit(0.0))


def month_label(year: str | Column, month: str | Column) -> Column:
    """'YYYY-MM' label with a zero-padded month."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return F.format_string("%04d-%02d", y.cast("int"), m.cast("int"))


def mb_from_bytes(col: str | Column) -> Column:
    """Bytes to MB (2^20) rounded to 2 decimals."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c / F.lit(1048576.0), 2)
