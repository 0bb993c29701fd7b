"""Sinks (K1-K5) with the stage row count observed during the write (A3).

Layouts:
* ``rebalance`` - a REBALANCE hint on the partition columns: one writer per
  partition where possible, and AQE splits a hot partition into several
  files (never one task for a month that holds a third of all rows).
* ``preserve`` - no shuffle: used when the input is already clustered by
  partition (a scan of a partitioned table), so each task writes the files of
  the partition it reads. Its scans are cut small (:func:`bounded_scans`), so that
  what a task sorts stays in memory at any size of the table.
Each task sorts its rows by the partition columns (and an optional secondary
key such as the pickup time, which tightens the Parquet min/max statistics that
later range filters use to skip row groups).
"""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow.session import filesystem
from tripflow.specs import PARTITION_COLUMNS

#: Rows of a written file at most. A file of so many rows is one row group, the least that a scan task can read.
FILE_ROWS = 1 << 20
#: Bytes of Parquet that a task of a ``preserve`` write scans at most (one row group at least): sorted rows take about
#: 100 bytes each, some ten times what they take in a file, and a task has a few hundred MB to sort in.
SORT_SCAN_BYTES = 16 << 20

_SPLIT_KEY = "spark.sql.files.maxPartitionBytes"
_scans_lock = threading.Lock()
_bounded: dict[int, list[str]] = {}  # session -> per write under way the setting before the first of them


@contextmanager
def bounded_scans(spark: SparkSession) -> Iterator[None]:
    """Scans that start inside give each task at most :data:`SORT_SCAN_BYTES`; a smaller setting stays. Writes may overlap
    (feeds run in threads): the last to end restores the setting."""
    session = spark._jsparkSession.hashCode()
    with _scans_lock:
        under_way = _bounded.setdefault(session, [])
        under_way.append(under_way[0] if under_way else spark.conf.get(_SPLIT_KEY))
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(under_way[0]) > SORT_SCAN_BYTES:
            spark.conf.set(_SPLIT_KEY, str(SORT_SCAN_BYTES))
    try:
        yield
    finally:
        with _scans_lock:
            before = under_way.pop()
            if not under_way:
                spark.conf.set(_SPLIT_KEY, before)
                del _bounded[session]


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A3: attach a row counter that fills in while the write runs (no second job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def prepare_layout(
    df: DataFrame,
    partition_cols: tuple[str, ...] = PARTITION_COLUMNS,
    layout: str = "rebalance",
    sort_within: tuple[str, ...] = (),
) -> DataFrame:
    """The frame exactly as it will be written (hint and per-task sort applied)."""
    if layout == "rebalance":
        df = df.hint("rebalance", *partition_cols)
    elif layout != "preserve":
        raise ValueError(f"unknown layout {layout!r}")
    if sort_within:
        df = df.sortWithinPartitions(*partition_cols, *sort_within)
    return df


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: tuple[str, ...] = PARTITION_COLUMNS,
    overwrite: str = "static",
    layout: str = "rebalance",
    sort_within: tuple[str, ...] = (),
    max_records_per_file: int | None = None,
    name: str = "write",
) -> int:
    """K1/K2/K4: write a partitioned Parquet table and return the row count.

    ``overwrite="static"`` replaces the whole table (K2); ``"dynamic"`` replaces
    only the partitions present in ``df`` and keeps the others (K1, an
    idempotent rerun of single months). The mode is set on this write only.
    """
    if overwrite not in ("static", "dynamic"):
        raise ValueError(f"overwrite must be static or dynamic, not {overwrite!r}")
    df, obs = observe_rows(prepare_layout(df, partition_cols, layout, sort_within), name)
    writer = (df.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
              .option("maxRecordsPerFile", max_records_per_file or FILE_ROWS).partitionBy(*partition_cols))
    with bounded_scans(df.sparkSession) if layout == "preserve" else nullcontext():
        writer.parquet(path)
    return int(obs.get.get("rows", 0))


def write_months(df: DataFrame, path: str, months: list[str], partition_cols: tuple[str, ...] = PARTITION_COLUMNS,
                 sort_within: tuple[str, ...] = ()) -> dict[str, int]:
    """K1: replace the partitions present in ``df`` and return the rows written for each of ``months`` ('YYYY-MM').

    One observed histogram counts all months, as a counter each would be evaluated for every row. Its counts are exact:
    it has a bin for every month, so only bins of the same month, at most rounding apart, are ever joined."""
    year, month = (F.col(c) for c in partition_cols)
    numbers = {100 * int(m[:4]) + int(m[5:]): m for m in months}
    number = 100 * year + month
    obs = Observation("months")
    counts = F.histogram_numeric(F.when(number.isin(list(numbers)), number).cast("double"), F.lit(max(2, len(numbers))))
    out = prepare_layout(df, partition_cols, "preserve", sort_within).observe(obs, counts.alias("rows"))
    writer = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .option("maxRecordsPerFile", FILE_ROWS).partitionBy(*partition_cols))
    with bounded_scans(df.sparkSession):
        writer.parquet(path)
    rows = dict.fromkeys(months, 0)
    for bin_ in obs.get["rows"] or []:  # a month can have a bin of several tasks
        rows[numbers[round(bin_["x"])]] += round(bin_["y"])
    return rows


def write_part(df: DataFrame, path: str, name: str = "part") -> int:
    """K1 for one partition: replace the folder ``path`` by ``df`` and return the rows written. The
    old files go before ``df`` is read, so this is only for rows that cannot fail."""
    out, obs = observe_rows(df, name)
    out.write.mode("overwrite").parquet(path)
    return int(obs.get.get("rows", 0))


def month_folder(path: str, month: str) -> str:
    """Folder of a month's ('YYYY-MM') partition."""
    return f"{path.rstrip('/')}/partition_year={int(month[:4])}/partition_month={int(month[5:])}"


def replace_months(df: DataFrame, path: str, months: list[str], sort_within: tuple[str, ...] = ()) -> dict[str, int]:
    """K1: make ``df`` all that the months hold; a month without rows in ``df`` loses the partition it had. Rows per month."""
    rows = write_months(df, path, months, sort_within=sort_within)
    for month in months:
        fs, folder = filesystem(df.sparkSession, month_folder(path, month))
        if not rows[month] and fs.exists(folder):
            fs.delete(folder, True)
    return rows


_VERSION = re.compile(r"v(\d{8})")


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions below ``path``, oldest first."""
    fs, p = filesystem(spark, path)
    names = [st.getPath().getName() for st in (fs.listStatus(p) if fs.exists(p) else []) if st.isDirectory()]
    return [n for n in sorted(names) if _VERSION.fullmatch(n) and fs.exists(filesystem(spark, f"{path}/{n}/_SUCCESS")[1])]


def current_version(spark: SparkSession, path: str) -> str:
    """Folder of the last complete version of the table at ``path``; ``path`` itself if it is not versioned."""
    path = path.rstrip("/")
    versions = _versions(spark, path)
    return f"{path}/{versions[-1]}" if versions else path


def publish_result(df: DataFrame, path: str, keep: int = 2) -> tuple[int, str]:
    """K3: a small result table as one Parquet file in a new version folder; returns (rows, folder).

    Nothing that a reader may have open is touched: the version counts once its ``_SUCCESS`` is there, and a failed
    write leaves the last one current. The last ``keep`` versions stay for readers that began before; older ones and
    broken attempts before them are removed after the new one is complete."""
    spark, path = df.sparkSession, path.rstrip("/")
    fs, p = filesystem(spark, path)
    taken = [int(m.group(1)) for st in (fs.listStatus(p) if fs.exists(p) else []) if (m := _VERSION.fullmatch(st.getPath().getName()))]
    name = f"v{max(taken, default=0) + 1:08d}"
    out, obs = observe_rows(df.coalesce(1), "result")
    out.write.mode("errorifexists").parquet(f"{path}/{name}")
    stays = _versions(spark, path)[-max(1, keep):]
    for st in fs.listStatus(p):
        own = st.getPath().getName()
        if _VERSION.fullmatch(own) and own < stays[0]:
            fs.delete(st.getPath(), True)
    return int(obs.get.get("rows", 0)), f"{path}/{name}"
