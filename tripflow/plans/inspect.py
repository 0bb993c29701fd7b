"""Plan inspection helpers for tests and tuning (no execution)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, returned instead of printed."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def count_exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the physical plan (before AQE re-planning)."""
    return sum(1 for line in plan_text(df, "simple").splitlines() if "Exchange " in line and "Reused" not in line)
