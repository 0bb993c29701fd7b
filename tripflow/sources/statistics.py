"""Counts of a stored layer from Parquet footers (A4, A5, A7): no data page is read.

:func:`statistics_scan` reads a Parquet table through the DataSource V2 scan, which answers ``count(*)`` and
``count(column)``, also grouped by all partition columns, from the row groups' statistics (the plan shows them as
``PushedAggregation``). The profiles of :mod:`tripflow.operators.profile` run on it as they are.

Only counts are meant to be asked this way: a footer's minimum and maximum of a double leave NaN out.
"""

from __future__ import annotations

from threading import Lock

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tripflow.operators.profile import null_profile

_V1_SOURCES = "spark.sql.sources.useV1SourceList"
_switching = Lock()


def statistics_scan(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """The Parquet table at ``path`` by a V2 scan; ``merge`` unites the columns of all its files.

    Which scan a frame uses is fixed when it is made, so the setting is put back at once."""
    with _switching:
        before = spark.conf.get(_V1_SOURCES)
        spark.conf.set(_V1_SOURCES, ",".join(s for s in before.split(",") if s != "parquet") or "none")
        try:
            return spark.read.option("mergeSchema", str(merge).lower()).parquet(path)
        finally:
            spark.conf.set(_V1_SOURCES, before)


def stored_null_profile(spark: SparkSession, path: str, columns: list[str] | tuple[str, ...], **labels: str) -> DataFrame:
    """A7 of a stored layer: (labels, coluna, total, nulos, pct_nulos), one row a column.

    From statistics if every file has them for every column. A file without the column (an earlier month), or one
    whose writer left out null counts, makes the pushed count fail; then the same profile reads the columns."""
    pushed = null_profile(statistics_scan(spark, path, merge=True), columns, **labels)
    try:
        return spark.createDataFrame(pushed.collect(), pushed.schema)  # one row a column
    except (PySparkException, Py4JError):
        return null_profile(spark.read.option("mergeSchema", "true").parquet(path), columns, **labels)
