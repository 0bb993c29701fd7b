"""Operator 7, URL filter: a blocked Bloom filter in front of an exact hash join.

A list holds canonical (host, path prefix) entries with a verdict. An entry fits a
url whose host is the entry's host or a subdomain of it and whose path starts with
the entry's path; of several the longest (host and path together, then the longer
host) wins. Every url is broken into the entries that could fit it; a blocked Bloom
filter of all listed entries (one 512-bit block per key, one bit in each of its eight
words) drops nearly all that are not listed; the rest meets the list in an exact
join, which removes the false positives. Urls without an entry get ``default``.

The filter has ``bits_per_key`` bits a key but never more than ``max_filter_bytes``:
that bound is what makes the broadcast safe. A list beyond it raises the share of
false positives, not the result.

Null urls and urls without ``://`` have empty host and path and no entry. Repeated rows
are judged each for itself. Entries listed twice count once; if they disagree, "block"
wins. Null hosts or paths in the list count as empty; an entry with an empty host fits
only urls with an empty host. An empty list gives ``default`` everywhere. Columns of
``urls`` other than those named are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tripflow.llm.common import ship

WORDS = 8
_SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31],
                  dtype=np.uint64)  # odd multipliers, one a word


def _hash(keys: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass"), 7) for k in keys), dtype=np.uint64, count=len(keys))


def _block_and_bits(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number and the bit (0..63) of each of its words, by key."""
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    low = (h & np.uint64(0xFFFFFFFF))[:, None]
    bits = ((low * _SALTS[None, :]) & np.uint64(0xFFFFFFFF)) >> np.uint64(26)
    return block.astype(np.int64), bits


class BlockedBloom:
    """The filter as an array of blocks; blocks without a key stay zero."""

    def __init__(self, words: np.ndarray):
        self.words = words  # (blocks, WORDS) uint64

    def might_contain(self, keys: list[str]) -> np.ndarray:
        if not keys:
            return np.zeros(0, dtype=bool)
        block, bits = _block_and_bits(_hash(keys), len(self.words))
        return (((self.words[block] >> bits) & np.uint64(1)) == 1).all(axis=1)


def build_bloom(listed: DataFrame, key: str, n_keys: int, bits_per_key: int = 16,
                max_filter_bytes: int = 64 << 20) -> BlockedBloom:
    """Build the filter on the executors: bits are or-ed per block before the shuffle, and
    only the finished blocks (at most ``max_filter_bytes``) reach the driver."""
    blocks = max(1, min(-(-n_keys * bits_per_key // (64 * WORDS)), max_filter_bytes // (8 * WORDS)))
    schema = "block long, " + ", ".join(f"w{i} long" for i in range(WORDS))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block, pos = _block_and_bits(_hash(b.column(0).to_pylist()), blocks)
            words = (np.uint64(1) << pos).astype(np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), *[pa.array(np.ascontiguousarray(words[:, i])) for i in range(WORDS)]],
                names=["block", *[f"w{i}" for i in range(WORDS)]])

    rows = (listed.select(key).mapInArrow(bits, schema)
            .groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]).collect())
    words = np.zeros((blocks, WORDS), dtype=np.int64)
    for r in rows:
        words[r[0]] = r[1:]
    return BlockedBloom(words.view(np.uint64))


def split_url(url) -> tuple:
    """Columns host (A-Z lower-cased) and path of a url column."""
    u = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(u, r"://([^/?#]*)", 1)
    return (F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.regexp_extract(u, r"://[^/?#]*([^?#]*)", 1))


def _suffixes(host: str) -> list[str]:
    """The host and every parent domain of it."""
    out, at = [host], host.find(".")
    while at >= 0:
        out.append(host[at + 1:])
        at = host.find(".", at + 1)
    return out


def filter_urls(spark: SparkSession, urls: DataFrame, listed: DataFrame, url: str = "url", keep: tuple[str, ...] = (),
                default: str = "allow", bits_per_key: int = 16, max_filter_bytes: int = 64 << 20) -> DataFrame:
    """Judge every row of ``urls`` by ``listed`` (host, path, verdict).

    Returns the ``keep`` columns, host, path, rule (the entry's host and path; null
    if none fits) and verdict.
    """
    ship(spark)
    rules = (listed.select(F.coalesce("host", F.lit("")).alias("_h"), F.coalesce("path", F.lit("")).alias("_p"), "verdict")
             .groupBy("_h", "_p").agg(F.max("verdict").alias("_verdict"))
             .select(F.concat("_h", F.lit("\u0000"), "_p").alias("_key"), F.concat("_h", "_p").alias("_rule"), "_verdict",
                     F.length("_h").alias("_host_len"), F.length("_p").alias("_path_len")))
    stats = rules.agg(F.count(F.lit(1)).alias("n"), F.collect_set("_path_len").alias("lens")).first()
    lengths = sorted(stats["lens"])  # distinct lengths: no more than the longest listed path has characters
    bloom = spark.sparkContext.broadcast(build_bloom(rules, "_key", stats["n"], bits_per_key, max_filter_bytes).words)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = BlockedBloom(bloom.value)
        for b in batches:
            hosts, paths = b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            keys: list[str] = []
            ends = []
            for host, path in zip(hosts, paths):
                cuts = [path[:n] for n in lengths if n <= len(path)]
                keys += [f"{h}\0{p}" for h in _suffixes(host) for p in cuts]
                ends.append(len(keys))
            hit = seen.might_contain(keys)
            out, start = [], 0
            for end in ends:
                out.append(sorted({keys[i] for i in np.flatnonzero(hit[start:end]) + start}))
                start = end
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, type=pa.list_(pa.string()))],
                                             names=[*b.schema.names, "_keys"])

    host, path = split_url(F.col(url))
    base = urls.select(F.monotonically_increasing_id().alias("_row"), *keep, host.alias("host"), path.alias("path"))
    schema = StructType([*base.schema, StructField("_keys", ArrayType(StringType()))])
    # A url without a possible entry keeps one row; its own number as the join key (entries hold
    # a NUL, this key does not) spreads those rows, where null keys would all meet in one task.
    hits = (base.mapInArrow(candidates, schema)
            .withColumn("_key", F.explode_outer("_keys"))
            .withColumn("_key", F.coalesce("_key", F.col("_row").cast("string")))
            .drop("_keys"))
    best = F.max(F.when(F.col("_verdict").isNotNull(),
                        F.struct((F.col("_host_len") + F.col("_path_len")).alias("len"), "_host_len", "_rule", "_verdict")))
    return (hits.join(rules, "_key", "left")
            .groupBy("_row", *keep, "host", "path").agg(best.alias("_best"))
            .select(*keep, "host", "path", F.col("_best._rule").alias("rule"),
                    F.coalesce(F.col("_best._verdict"), F.lit(default)).alias("verdict")))
