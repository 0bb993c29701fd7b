"""Helpers shared by the operators: tables, scratch tables and global row order."""

from __future__ import annotations

import os
import shutil
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import tripflow
from tripflow.session import application_id, scratch_path

#: A word is a run of characters other than space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_ROW_BITS = 33  # monotonically_increasing_id(): partition number above, row within it below


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that functions that run
    there can import it (the archive is built on the driver and served by Spark)."""
    app = application_id(spark)
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(tripflow.__file__))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tripflow-ship-"), "tripflow"), "zip",
                                      root_dir=os.path.dirname(package), base_dir=os.path.basename(package))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)


def bound_batches(spark: SparkSession, most_rows: int = 1024) -> None:
    """Let a batch of whole texts that goes to Python have at most ``most_rows`` rows (Spark bounds batches by rows alone)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= most_rows:
        spark.conf.set(key, str(most_rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(spark: SparkSession, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back.

    The written table cuts the lineage: a lost executor never makes a row number,
    a sample or a Python result be computed again with another outcome.
    """
    path = scratch_path(spark, "llm", name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(spark: SparkSession, df: DataFrame, row: str, name: str) -> DataFrame:
    """A stored copy of ``df`` with a unique number ``row`` for every row, so that rows which repeat an id
    or agree in every column can be told apart by all who read the copy."""
    if row in df.columns:
        raise ValueError(f"the input already has a column {row}")
    return materialize(spark, df.withColumn(row, F.monotonically_increasing_id()), name)


def small_frame(spark: SparkSession, rows: list[dict], schema: pa.Schema) -> DataFrame:
    """A local relation of known size, so that the planner sees how small it is."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def rank_rows(spark: SparkSession, df: DataFrame, order: list[Column], name: str,
              totals: tuple[str, ...] = (), drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``row_no`` (0, 1, ... in ``order``) and, for each column c of ``totals``,
    ``c_before``: the sum of c over all earlier rows. The columns ``drop`` serve the order alone.

    No window over the whole table: rows are range-partitioned and sorted, numbered
    within their partition, and shifted by the sizes of the partitions before. Only
    those sizes (one row per partition) reach the driver. The order within ties is
    fixed by the written table. ``df`` is read twice (the range sample), so pass one
    that is cheap to read.
    """
    ordered = (df.repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_at", F.monotonically_increasing_id()).drop(*drop))
    ordered = materialize(spark, ordered, name).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    parts = (ordered.groupBy("_part")
             .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in totals])
             .orderBy("_part").collect())
    offsets, run = [], {"n": 0, **{c: 0 for c in totals}}
    for p in parts:
        offsets.append({"_part": p["_part"], **{f"_{k}": v for k, v in run.items()}})
        run = {k: v + (p[k] or 0) for k, v in run.items()}
    schema = pa.schema([("_part", pa.int64()), *[(f"_{k}", pa.int64()) for k in run]])
    out = ordered.join(small_frame(spark, offsets, schema), "_part")
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("row_no", F.col("_n") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    for c in totals:
        out = out.withColumn(f"{c}_before", F.col(f"_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0)))
    return out.drop("_part", "_at", *[f"_{k}" for k in run])
