"""Operator 9, sharding: a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in a fixed order. A balanced Feistel network permutes
the smallest even-bit power of two that holds n; cycle walking (permuting again
while the image is n or more) restricts it to 0..n-1. The permuted number p gives
shard ``p mod shards`` and slot ``p div shards``, so shard sizes differ by at most
one, slots have no gaps, and either direction can be computed for one row without
the others: :func:`place` and :func:`row_at`.

Nulls, ties and repeated rows: null order keys come first; rows equal in every
order key are interchangeable (each gets one of their numbers). An empty table
gives an empty result. Other columns are carried along unchanged; an input column named like
one of the result (``row_no``, ``shard``, ``slot``) or of the work (``_uid``, ``_at``, ``_part``,
``_n``) raises.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import materialize, rank_rows, ship

ROUNDS = 4
#: Names that :func:`shard_rows` gives itself.
OWN_COLUMNS = ("row_no", "shard", "slot", "_uid", "_at", "_part", "_n")


def _round(half: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    """A keyed mix of one half (multiply and shift, modulo 2**64)."""
    x = (half + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) & mask


def _keys(seed: int) -> list[int]:
    return [(seed * 1_000_003 + r * 0x632BE59BD9B4E019 + 1) % (1 << 64) for r in range(ROUNDS)]


def _walk(x: np.ndarray, n: int, seed: int, inverse: bool) -> np.ndarray:
    """The permutation of 0..n-1 (or its inverse) of each element of ``x``."""
    out = np.asarray(x, dtype=np.uint64).copy()
    if n <= 1:
        return out.astype(np.int64)
    bits = np.uint64(-(-(n - 1).bit_length() // 2))
    mask = np.uint64((1 << int(bits)) - 1)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & mask
        for key in reversed(_keys(seed)) if inverse else _keys(seed):
            if inverse:
                left, right = right ^ _round(left, key, mask), left
            else:
                left, right = right, left ^ _round(right, key, mask)
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def place(rows: np.ndarray, n: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of each row number."""
    p = _walk(rows, n, seed, inverse=False)
    return p % shards, p // shards


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int) -> np.ndarray:
    """The row number that stands at each (shard, slot)."""
    return _walk(np.asarray(slot) * shards + np.asarray(shard), n, seed, inverse=True)


def shard_rows(spark: SparkSession, df: DataFrame, order: list[str], shards: int, seed: int = 9) -> DataFrame:
    """``df`` with ``row_no`` (long), ``shard`` (int) and ``slot`` (long).

    ``order`` names the columns that fix the row numbers. ``df`` is written once, so
    that the range sample and the numbering read the stored rows and not its source.
    """
    clash = [c for c in df.columns if c.lower() in OWN_COLUMNS]
    if clash:
        raise ValueError(f"the input already has columns {clash}")
    ship(spark)
    stored = materialize(spark, df.withColumn("_uid", F.monotonically_increasing_id()), "shard-input")
    n = stored.count()
    # _uid last: rows that agree in every key can still be dealt to several partitions.
    keys: list[Column] = [F.col(c).asc_nulls_first() for c in order] + [F.col("_uid")]
    ranked = rank_rows(spark, stored, keys, "shard-order").drop("_uid")

    @F.pandas_udf("long")
    def permuted(row_no: pd.Series) -> pd.Series:
        return pd.Series(_walk(row_no.to_numpy(), n, seed, inverse=False))

    return (ranked.withColumn("slot", permuted("row_no"))
            .withColumn("shard", (F.col("slot") % shards).cast("int"))
            .withColumn("slot", F.expr(f"slot div {int(shards)}")))


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard, rows in slot order; files are bounded and dealt by range of slots."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path))
