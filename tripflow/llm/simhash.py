"""Operator 4, SimHash near-dedup by anchor-point covering.

A text's fingerprint has 64 bits: a bit is one if it is set in over half of the XXH64
hashes (seed 42) of the text's word shingles. Fingerprints at most ``max_bits`` (0 to 4)
apart are linked, and linked documents form components.

Finding the links: the 64 bits are cut into blocks A and B of 23 bits and C of 18. The
anchors of a 23-bit block are the 4,096 words of the perfect binary Golay code, whose
covering radius is 3. Two blocks at most 2 apart have a point within 1 of both, and the
anchor that covers this point lies within 3 + 1 of both; so each block is replicated to
every anchor within covering radius plus 1 (six at most). Let a linked pair differ by
a + b + c <= 4 bits in the blocks. Then

* a <= 2 and b <= 2: the pair meets at an anchor of A together with an anchor of B;
* else one of a, b is 3 or more, the other two blocks differ in 1 bit at most, so one of
  them is equal: the pair meets at that block's own value (every word an anchor, radius 0).

Only distinct fingerprints are compared; copies of a text share one. At an anchor all its
fingerprints are compared, but only a spanning forest of their links leaves it. An anchor
with more than ``GROUP`` fingerprints is cut into chunks, and every pair of chunks becomes
a group of its own, so a group's memory is bounded and a hot anchor is many tasks.

Null, empty and white-space texts have no words and the fingerprint zero, which is linked
like any other. Texts with fewer words than a shingle are hashed whole. Texts of any length
are hashed whole, in bounded pieces. Repeated rows and repeated doc_ids are documents of
their own in one component. A null doc_id is never the smallest; a component of null
doc_ids alone has a null component_id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import materialize, ship
from tripflow.llm.components import connected_components

SEED = 42
GROUP = 4096
_PIECE = 1 << 16  # shingles counted at once
_A, _B, _C = (0, 23), (23, 23), (46, 18)  # first bit and width of the blocks


# -- fingerprints --------------------------------------------------------------
def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The 64-bit fingerprint of a text in UTF-8 (A-Z lower-cased, words between ASCII white space)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - size + 1]
    ends = ends[size - 1:]
    ones, n = np.zeros(64, dtype=np.int64), len(starts)
    for k in range(0, n, _PIECE):
        cuts = map(joined.__getitem__, map(slice, starts[k:k + _PIECE].tolist(), ends[k:k + _PIECE].tolist()))
        h = np.fromiter(map(xxhash.xxh64_intdigest, cuts, repeat(SEED)), dtype="<u8", count=min(_PIECE, n - k))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view("<u8")[0])


def fingerprints(spark: SparkSession, df: DataFrame, keys: list[str], text: str = "text", shingle: int = 4) -> DataFrame:
    """The ``keys`` of each row and its ``fp`` (the fingerprint's bits as a signed long)."""
    ship(spark)
    kept = df.select(*keys, F.col(text).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(len(keys))), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], names=[*keys, "fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:len(keys)])
    return kept.mapInArrow(run, f"{schema}, fp long")


def hex_digits(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# -- anchors -------------------------------------------------------------------
class GolayAnchors:
    """Words of the binary Golay code near a 23-bit value.

    The code is cyclic with the generator x^11 + x^9 + x^7 + x^6 + x^5 + x + 1; its upper
    12 bits number a word. What lies near a value depends only on its remainder.
    """

    GENERATOR, RADIUS = 0b101011100011, 3

    def __init__(self, beyond: int = 1):
        low, high = (np.array([self._remainder(v << s) for v in range(1 << 12 if not s else 1 << 11)], dtype=np.int64) for s in (0, 12))
        self.low, self.high = low, high
        errors = np.zeros(1, dtype=np.int64)
        every = [errors]
        for _ in range(self.RADIUS + beyond):  # all error patterns of one more bit
            errors = np.unique((errors[:, None] | (1 << np.arange(23))[None, :]).ravel())
            every.append(errors)
        errors = np.unique(np.concatenate(every))
        of = self.remainder(errors)
        order = np.argsort(of, kind="stable")
        self.errors, self.first = errors[order], np.searchsorted(of[order], np.arange(2049))

    @classmethod
    def _remainder(cls, v: int) -> int:
        for k in range(22, 10, -1):
            if v >> k & 1:
                v ^= cls.GENERATOR << (k - 11)
        return v

    def remainder(self, v: np.ndarray) -> np.ndarray:
        return self.low[v & 0xFFF] ^ self.high[v >> 12]

    def near(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``v``, number of the anchor) for every anchor within radius plus ``beyond``."""
        r = self.remainder(v)
        count = self.first[r + 1] - self.first[r]
        at = np.repeat(np.arange(len(v)), count)
        step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        return at, (v[at] ^ self.errors[self.first[r][at] + step]) >> 11


def _block(fp: np.ndarray, block: tuple[int, int]) -> np.ndarray:
    return ((fp >> np.uint64(block[0])) & np.uint64((1 << block[1]) - 1)).astype(np.int64)


_GOLAY: list[GolayAnchors] = []


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``fp``, anchor) of every anchor that a fingerprint is replicated to."""
    if not _GOLAY:
        _GOLAY.append(GolayAnchors())
    golay, n = _GOLAY[0], len(fp)
    at_a, anchor_a = golay.near(_block(fp, _A))
    at_b, anchor_b = golay.near(_block(fp, _B)[at_a])  # each anchor of A with each of B
    both = anchor_a[at_b] << 12 | anchor_b
    own = [_block(fp, x) | (k + 1) << 24 for k, x in enumerate((_A, _B, _C))]
    return np.concatenate([at_a[at_b], *[np.arange(n)] * 3]), np.concatenate([both, *own])


# -- comparison ----------------------------------------------------------------
_SMALL = 12  # groups up to this size are compared together, by distance in the sorted rows


def _forest(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one group."""
    out, left = [], np.arange(len(fp))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            u = queue.pop()
            linked = np.bitwise_count(fp[left] ^ fp[u]) <= max_bits
            out += [(u, v) for v in left[linked]]
            queue.extend(left[linked])
            left = left[~linked]
    return out


def links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links within groups; rows (anchor, part, fp) come sorted, and a group may run on into the next batch."""
    held = None
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        edges = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        starts = np.concatenate(([0], edges)) if len(fp) else np.zeros(0, dtype=np.int64)
        sizes = np.diff(np.concatenate((starts, [len(fp)])))
        group, size = np.repeat(np.arange(len(sizes)), sizes), np.repeat(sizes, sizes)
        left, right = [], []
        rest = np.flatnonzero((size > 1) & (size <= _SMALL))
        for k in range(1, _SMALL):
            i = rest[:-k]
            j = rest[k:]
            ok = (group[i] == group[j]) & (np.bitwise_count(fp[i] ^ fp[j]) <= max_bits)
            left.append(fp[i[ok]])
            right.append(fp[j[ok]])
        for g in np.flatnonzero(sizes > _SMALL):
            own = fp[starts[g]:starts[g] + sizes[g]]
            pairs = np.array(_forest(own, max_bits), dtype=np.int64).reshape(-1, 2)
            left.append(own[pairs[:, 0]])
            right.append(own[pairs[:, 1]])
        a, b = np.concatenate(left), np.concatenate(right)
        pairs = np.unique(np.stack([a, b], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))], schema=schema)

    for batch in batches:
        key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
        fp = batch.column(2).to_numpy().view(np.uint64)
        if held is not None:
            key, fp = np.concatenate((held[0], key)), np.concatenate((held[1], fp))
        if not len(fp):
            continue
        cut = len(fp) - int((key[::-1] == key[-1]).all(axis=1).argmin()) if (key != key[-1]).any() else 0
        held = key[cut:], fp[cut:]  # the last group may go on; a group is bounded
        if cut:
            yield compare(key[:cut], fp[:cut])
    if held is not None:
        yield compare(*held)


def linked_pairs(spark: SparkSession, distinct_fp: DataFrame, max_bits: int = 4, group: int = GROUP) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of the stored table ``distinct_fp`` (fp):
    enough of them to connect what any chain of links connects."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the anchors cover distances of 0 to 4 bits")
    ship(spark)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for k in range(0, len(fp), 1 << 14):
                part = fp[k:k + (1 << 14)]
                at, anchor = anchors(part)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[at].view(np.int64))], names=["anchor", "fp"])

    entries = materialize(spark, distinct_fp.select("fp").mapInArrow(replicate, "anchor long, fp long"), "simhash-anchors")
    hot = materialize(spark, entries.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group), "simhash-hot")
    # Chunks of an anchor's fingerprints; part = i * chunks + j stands for the pair of chunks i <= j.
    chunks = F.expr(f"coalesce((n + {group} - 1) div {group}, 1)")
    dealt = (entries.join(hot, "anchor", "left").withColumn("chunks", chunks)
             .withColumn("own", F.expr("pmod(xxhash64(fp), chunks)"))
             .withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)")))
             .select("anchor", (F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")).alias("part"), "fp"))
    return (dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "fp")
            .mapInArrow(lambda batches: links(batches, max_bits), "a long, b long"))


def near_duplicates(spark: SparkSession, df: DataFrame, keys: list[str], id_col: str = "doc_id", text: str = "text",
                    shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The ``keys`` of each row with ``fp``, ``root`` (the component) and ``component_id``
    (the smallest ``id_col`` in it; ``id_col`` is among the keys)."""
    marked = materialize(spark, fingerprints(spark, df, keys, text, shingle), "simhash-fingerprints")
    classes = materialize(spark, marked.groupBy("fp").agg(F.min(id_col).alias("first_id")), "simhash-classes")
    pairs = linked_pairs(spark, classes, max_bits)
    roots = connected_components(spark, pairs)
    rooted = materialize(spark, classes.join(roots, classes["fp"] == roots["node"], "left")
                         .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = materialize(spark, rooted.select("fp", "root").join(ids, "root"), "simhash-components")
    return marked.join(of_fp, "fp")
