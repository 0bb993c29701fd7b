"""Operator 10, token ids in binary files: frequency-ranked, byte-aligned, with separate control bytes.

Ids are replaced by their rank in the corpus (the most frequent id is 0, counted over all
documents) and written in one to four bytes, low byte first. Two bits an id give its length;
four of them make a control byte, and the control bytes stand apart from the data, so that
a block is decoded by table lookup: a table gives the four lengths of each control byte,
their running sum the place of every id.

A store is a folder with ``ranks`` (Parquet: id, count, rank; one row per vocabulary entry)
and ``blocks`` (files of blocks, the files in order of document id). A block holds whole
documents:

    b"TKB1", u32 documents, u64 ids, u64 data bytes,
    per document: i64 id, u8 null flag, i64 ids; control bytes; data bytes

all little-endian; a newline ends each block. Files are written by Spark's text writer from
raw bytes, so task retries and commits are Spark's and any file system it writes to will do.

Null texts count as empty; every document ends with the end id, so it has one id at least.
Null document ids come first. Documents with one id stand in the order of their length,
then of their ids' checksum; equal rows are interchangeable. A text of any length is one
document in one block. Other columns are not read. An empty table gives an empty store.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import bpe
from tripflow.llm.common import materialize, ship, small_frame

MAGIC = b"TKB1"
BLOCK_IDS = 1 << 19
BLOCKS_PER_FILE = 64

#: Lengths of the four ids of each control byte.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of 32-bit values."""
    r = ranks.astype(np.uint32)
    size = 1 + (r >= 1 << 8).astype(np.int64) + (r >= 1 << 16) + (r >= 1 << 24)
    codes = np.zeros(-(-len(r) // 4) * 4, dtype=np.uint8)
    codes[:len(r)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    at = np.cumsum(size) - size
    data = np.empty(int(size.sum()), dtype=np.uint8)
    data[at] = r & 0xFF
    for k in (1, 2, 3):
        has = np.flatnonzero(size > k)
        if not len(has):
            break
        data[at[has] + k] = (r[has] >> np.uint32(8 * k)) & 0xFF
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of :func:`pack`, by table lookup."""
    size = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:n].astype(np.int64)
    at = np.cumsum(size) - size
    raw = np.frombuffer(data, dtype=np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        has = np.flatnonzero(size > k)
        if not len(has):
            break
        out[has] |= raw[at[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_block(doc_ids: list[int | None], ranks: list[np.ndarray]) -> bytes:
    every = np.concatenate(ranks)
    control, data = pack(every)
    return b"".join([
        MAGIC, np.array([len(doc_ids)], "<u4").tobytes(), np.array([len(every), len(data)], "<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], "u1").tobytes(),
        np.array([len(r) for r in ranks], "<i8").tobytes(), control, data])


def read_blocks(content: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, ids per document, ranks) of every block of a file."""
    at = 0
    while at < len(content):
        if content[at:at + 4] != MAGIC:
            raise ValueError("not a block")
        docs = int(np.frombuffer(content, "<u4", 1, at + 4)[0])
        n, size = (int(x) for x in np.frombuffer(content, "<u8", 2, at + 8))
        at += 24
        ids, nulls = np.frombuffer(content, "<i8", docs, at), np.frombuffer(content, "u1", docs, at + 8 * docs)
        lengths = np.frombuffer(content, "<i8", docs, at + 9 * docs)
        at += 17 * docs
        control = -(-n // 4)
        yield ([None if null else int(i) for i, null in zip(ids, nulls)], lengths,
               unpack(content[at:at + control], content[at + control:at + control + size], n))
        at += control + size + 1  # and the newline


class LibraryEncoder(bpe.Encoder):
    """The same split; new words go to the ``tokenizers`` library's model, at a higher price, so more are remembered. Encodes only."""

    most_bytes = 160 << 20

    def _read(self, model):  # the library has its own tables
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_str(self.content.decode())
        self._model = self._tokenizer.model
        self._names = dict(enumerate(self.byte_of))

    def learn(self, words):
        # All words in the vocabulary's alphabet at once, then cut again: a character stands for a byte.
        as_bytes = [w.encode("utf-8", "surrogateescape") for w in words]
        named, ends, tokenize = b"".join(as_bytes).decode("latin-1").translate(self._names), list(accumulate(map(len, as_bytes))), self._model.tokenize
        tokens = [tokenize(named[x:y]) for x, y in zip([0, *ends], ends)]
        flat, cuts = array("i", [t.id for t in chain.from_iterable(tokens)]).tobytes(), [4 * n for n in accumulate(map(len, tokens))]
        return [flat[x:y] for x, y in zip([0, *cuts], cuts)]


def tokenized(spark: SparkSession, docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """Stored rows (doc_id, n, ids): the ids of each text and the end id, as little-endian integers of
    two bytes in a binary, or of four if the vocabulary has over 65,536 ids."""
    ship(spark)
    content = spark.sparkContext.broadcast(bpe.read_vocabulary(vocabulary))
    spec = json.loads(content.value)
    kind = "<u2" if max([end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) < 1 << 16 else "<u4"
    width, end = int(kind[2]), np.array([end_id], dtype=kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(content.value, LibraryEncoder)
        for b in batches:
            start, held, size = 0, [], 0
            for ids in enc.encode(t.as_py() for t in b.column(1)):
                held.append(ids.astype(kind).tobytes() + end)
                size += len(held[-1])
                if size >= 1 << 22 or start + len(held) == b.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(start, len(held)), pa.array([len(x) // width for x in held], type=pa.int64()), pa.array(held, type=pa.binary())],
                        names=["doc_id", "n", "ids"])
                    start, held, size = start + len(held), [], 0

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return materialize(spark, rows.mapInArrow(run, "doc_id long, n long, ids binary"), "token-rows", compression="zstd")


def _stored_ids(rows: bytes, n: int) -> np.ndarray:
    """The ``n`` ids of stored rows."""
    return np.frombuffer(rows, dtype=f"<u{len(rows) // max(1, n)}" if n else "<u4")


def rank_table(spark: SparkSession, rows: DataFrame) -> list[tuple[int, int]]:
    """(id, count) in order of rank. As many rows as distinct ids, so the vocabulary bounds them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for b in batches:
            own = np.bincount(_stored_ids(b"".join(b.column(1).to_pylist()), sum(b.column(0).to_pylist())))
            if len(own) > len(total):
                own, total = total, own
            total[:len(own)] += own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    counts = rows.select("n", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return sorted(((r["id"], r["n"]) for r in counts), key=lambda x: (-x[1], x[0]))


def write_store(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Write the stored ``rows`` (doc_id, n, ids) as a store at ``path``."""
    ship(spark)
    ranked = rank_table(spark, rows)
    schema = pa.schema([("id", pa.int64()), ("count", pa.int64()), ("rank", pa.int64())])
    small_frame(spark, [{"id": i, "count": n, "rank": k} for k, (i, n) in enumerate(ranked)], schema).coalesce(1).write.parquet(f"{path}/ranks")
    of_id = np.zeros(max((i for i, _ in ranked), default=0) + 1, dtype=np.uint32)
    for k, (i, _) in enumerate(ranked):
        of_id[i] = k
    ranks = spark.sparkContext.broadcast(of_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, held, size = [], [], 0
        for b in batches:
            for doc_id, n, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                doc_ids.append(doc_id)
                held.append(ranks.value[_stored_ids(ids.as_py(), n)])
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield pa.RecordBatch.from_arrays([pa.array([write_block(doc_ids, held)], type=pa.binary())], names=["block"])
                    doc_ids, held, size = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([write_block(doc_ids, held)], type=pa.binary())], names=["block"])

    # The row number comes last, so that equal rows can still be dealt to several partitions.
    rows = rows.withColumn("crc", F.crc32("ids")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("n"), F.col("crc"), F.col("row")]
    blocks = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("doc_id", "n", "ids").mapInArrow(run, "block binary"))
    # A cast keeps the bytes as they are; the text writer copies them and adds the newline.
    (blocks.select(F.col("block").cast("string").alias("value")).write.option("lineSep", "\n")
     .option("maxRecordsPerFile", BLOCKS_PER_FILE).text(f"{path}/blocks"))


def read_store(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a store: doc_id, start (ids of all documents before), n, crc (of the ids as
    little-endian 32-bit integers) and, if ``with_ids``, ids (array of int)."""
    ship(spark)
    table = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").collect()  # bounded by the vocabulary
    ids_of = spark.sparkContext.broadcast(np.array([r[0] for r in table], dtype="<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                part, sub = map(int, re.search(r"part-(\d+)-.*-c(\d+)[^/]*$", name).groups())
                before = 0
                for doc_ids, lengths, ranks in read_blocks(content.as_py()):
                    ids = ids_of.value[ranks]
                    ends = np.cumsum(lengths)
                    cuts = list(zip((ends - lengths).tolist(), ends.tolist()))
                    columns = [pa.array([part] * len(cuts), pa.int32()), pa.array([sub] * len(cuts), pa.int32()),
                               pa.array(before + ends - lengths), pa.array(doc_ids, pa.int64()), pa.array(lengths),
                               pa.array([zlib.crc32(ids[x:y]) for x, y in cuts], pa.int64())]
                    names = ["part", "sub", "at", "doc_id", "n", "crc"]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.astype(np.int32))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    before += int(ends[-1])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/blocks").select("path", "content")
    schema = "part int, sub int, at long, doc_id long, n long, crc long" + ", ids array<int>" * with_ids
    docs = materialize(spark, files.mapInArrow(run, schema), "token-docs")
    totals = docs.groupBy("part", "sub").agg(F.sum("n").alias("n")).orderBy("part", "sub").collect()  # one row per file
    before = accumulate((t["n"] for t in totals), initial=0)
    offsets = [{"part": t["part"], "sub": t["sub"], "before": x} for t, x in zip(totals, before)]
    schema = pa.schema([("part", pa.int32()), ("sub", pa.int32()), ("before", pa.int64())])
    return (docs.join(small_frame(spark, offsets, schema), ["part", "sub"])
            .withColumn("start", F.col("before") + F.col("at")).drop("part", "sub", "at", "before"))
