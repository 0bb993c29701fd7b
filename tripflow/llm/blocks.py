"""Exchange of packed arrays between chunks of the corpus and buckets of keys.

Operators that compare billions of small things (words, windows) keep them as numpy arrays: a
*chunk* is one row that holds the texts of some documents, a *bucket* is one row group that holds
a range of keys from all chunks. A chunk sends every bucket one packed block, in which each of its
keys stands once (so a key that is everywhere comes once a chunk, never once a document), and gets
one packed block back. Spark moves the blocks; both sides are bounded by the sizes chosen.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CODEC = pa.Codec("zstd", 3)
_SERIAL_BITS = 32


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of fixed-width numbers in one compressed string, the first bytes of all numbers first, then the second ones and so on."""
    head = struct.pack("<I", len(arrays)) + b"".join(struct.pack("<4sQ", a.dtype.str.encode().ljust(4), len(a)) for a in arrays)
    raw = head + b"".join(_planes(a) for a in arrays)
    return struct.pack("<Q", len(raw)) + _CODEC.compress(raw, asbytes=True)


def _planes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if a.dtype.itemsize > 1 and len(a) else a.tobytes()


def unpack(data: bytes) -> list[np.ndarray]:
    raw = _CODEC.decompress(data[8:], struct.unpack_from("<Q", data)[0], asbytes=True)
    at, out = 4 + 12 * struct.unpack_from("<I", raw)[0], []
    for kind, n in struct.iter_unpack("<4sQ", raw[4:at]):
        dtype = np.dtype(kind.decode().strip())
        one = np.frombuffer(raw, dtype=np.uint8, count=n * dtype.itemsize, offset=at)
        out.append(np.ascontiguousarray(one.reshape(dtype.itemsize, n).T).view(dtype).reshape(n) if dtype.itemsize > 1 else one.view(dtype))
        at += n * dtype.itemsize
    return out


def least_width(x: np.ndarray) -> np.ndarray:
    """Non-negative whole numbers in the narrowest type that holds them."""
    most = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def serials() -> Iterator[int]:
    """Numbers for the rows that this task makes, apart from those of every other task of its stage."""
    start = TaskContext.get().partitionId() << _SERIAL_BITS
    while True:
        yield start
        start += 1


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(first column, the other columns of its rows) of rows that are sorted by the first column."""
    key, held = None, []
    for k, *rest in rows(batches):
        if held and k != key:
            yield key, held
            held = []
        key = k
        held.append(tuple(rest))
    if held:
        yield key, held


def by_bucket(blocks: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, ...) with all rows of a bucket side by side in one partition."""
    return blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")


def by_chunk(chunks: DataFrame, replies: DataFrame) -> DataFrame:
    """Rows (chunk, part, data): a chunk's replies (part is their bucket), then the chunk itself (part null)."""
    both = replies.select("chunk", F.col("bucket").alias("part"), "data").unionByName(
        chunks.select("chunk", F.lit(None).cast("int").alias("part"), "data"))
    return both.repartition("chunk").sortWithinPartitions("chunk", F.col("part").asc_nulls_last())


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows that agree in all columns starts."""
    change = np.zeros(len(columns[0]), dtype=bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def cut_by(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(bucket, its rows) of rows in ascending order of their bucket."""
    at = runs(bucket)
    for start, stop in zip(at.tolist(), [*at[1:].tolist(), len(bucket)]):
        yield int(bucket[start]), slice(start, stop)
