"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM side, codegen friendly)."""

from tripflow.functions.columns import (  # noqa: F401
    in_range,
    mb_from_bytes,
    month_label,
    ntz,
    pct_half_up,
    round2,
)
