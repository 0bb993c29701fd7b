"""Operator 13, removal of passages that repeat across documents, by level-wise doubling.

A word of a document is removed if a window of ``window`` consecutive words covers it whose word
sequence also starts in a document with a smaller id. All windows are judged on the input.

Levels: the lengths double up to ``window`` (for 13 words: 7, then 13; a longer window has more
levels). A window of one length is only looked at if it was found repeated at the length before:

* The corpus is packed into chunks of about ``CHUNK_WORDS`` words. At a level below the last, every
  wanted window is stood for by the least hash among the windows of the level's length inside it, so
  neighbours share one, and equal windows have the same one. A chunk sends its distinct hashes
  (32 bits within a bucket of keys) to their buckets. A hash of two chunks, or of two documents of
  one chunk, is repeated; all others end here, and with them the windows that they stand for. What
  repeats is extended to twice the length. (A false match of two hashes only lets a window go on.)
* At the last length a chunk sends its surviving windows, each distinct one once with the least
  document id that has it here, compared by 96 bits. Its bucket says whether a smaller id has it too.

Hashes of longer windows are made of two overlapping ones of half the length. A window that every
document has comes once a chunk, so no key is hot: neither chunks nor buckets grow with a group of copies.

Words are runs of characters other than space and the ASCII controls tab to carriage return. A null,
empty or white-space text has no words, and no document shorter than ``window`` loses any. Rows that
repeat a document id are documents of their own, none smaller than the other. A document with a null
id is not smaller than any, and none is smaller than it: it keeps all words and removes none. Texts of
any length are handled whole; a chunk has at least one document, which a task holds in memory. An
empty table gives an empty result. Only the two named columns are read; others do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.blocks import by_bucket, by_chunk, cut_by, groups, least_width, pack, runs, rows, serials, unpack
from tripflow.llm.common import bound_batches, materialize, ship

CHUNK_WORDS = 1 << 20
BUCKET_WORDS = 1 << 21  # of the corpus for each bucket of keys
_PIECE_WORDS = 1 << 16
_OUT_BYTES = 1 << 23
_FIRST = 7  # the ladder's first length is not below this, if the window is not

_U = np.uint64
_FACTORS = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_M1, _M2, _M3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0xD6E8FEB86659FD93)


def ladder(window: int) -> list[int]:
    """Lengths of the levels: each at most twice the one before, the last the window itself."""
    out = [window]
    while (half := out[0] // 2 + 1) >= _FIRST and half < out[0]:
        out.insert(0, half)
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _M3
    return h ^ (h >> _U(29))


class Chunk:
    """The words of a chunk: documents joined by line feeds, their words by single spaces."""

    def __init__(self, data: bytes):
        ids, known, counts, text = unpack(data)
        self.ids, self.known = ids, known.astype(bool)
        self.text, self.counts = text.tobytes(), counts.astype(np.int64)
        self.doc = np.repeat(np.arange(len(ids)), self.counts)

    def _words(self) -> np.ndarray:
        """A 64-bit hash of each word, multilinear in its bytes."""
        raw = np.frombuffer(self.text, dtype=np.uint8)
        gap = (raw == 32) | (raw == 10)
        first = ~gap
        first[1:] &= gap[:-1]
        starts = np.flatnonzero(first)
        out = np.empty(len(starts), dtype=np.uint64)
        for k in range(0, len(starts), _PIECE_WORDS):
            at = starts[k:k + _PIECE_WORDS]
            stop = starts[k + _PIECE_WORDS] if k + _PIECE_WORDS < len(starts) else len(raw)
            size = np.diff(at, append=stop)
            place = np.arange(stop - at[0]) - np.repeat(at - at[0], size)
            each = raw[at[0]:stop].astype(np.uint64) + _U(1)
            each *= _FACTORS[place & 255]
            if size.max() > 256:
                each *= (place >> 8).astype(np.uint64) * _U(2) + _U(1)
            each[gap[at[0]:stop]] = 0
            out[k:k + _PIECE_WORDS] = np.add.reduceat(each, at - at[0])
        return mixed(out)

    def hashes(self, length: int, lane: int = 0) -> np.ndarray:
        """Hash of the ``length`` words from each word on (documents apart are not told apart here)."""
        h, n = self._words() if not lane else mixed(self._words() * _M2 + _U(lane)), 1
        left, right = (_M1, _M2) if not lane else (_M2, _M1)
        while n < length:
            step = min(n, length - n)
            h = mixed(h[:-step] * left + (h[step:] ^ (h[step:] >> _U(31))) * right) if len(h) > step else h[:0]
            n += step
        return h

    def windows(self, length: int) -> np.ndarray:
        """First words of all windows of documents with an id."""
        n = len(self.doc) - length + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero((self.doc[:n] == self.doc[length - 1:]) & self.known[self.doc[:n]])


def _least_of(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = 1
    while n < width:
        step = min(n, width - n)
        h = np.minimum(h[:-step], h[step:]) if len(h) > step else h[:0]
        n += step
    return h


def _keys(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (above) and the 32 bits compared in it (below)."""
    return ((h >> _U(32)) * _U(buckets) >> _U(32)) << _U(32) | h & _U(0xFFFFFFFF)


def survivors(chunk: Chunk, window: int, buckets: int, repeated: np.ndarray | None, before: int | None) -> np.ndarray:
    """First words of the windows whose key at the level ``before`` is in ``repeated``; of all windows at the first level."""
    at = chunk.windows(window)
    if before is not None and len(at):
        at = at[_known(_stand_ins(chunk, window, before, buckets)[at], repeated)]
    return at


def _stand_ins(chunk: Chunk, window: int, length: int, buckets: int) -> np.ndarray:
    return _keys(mixed(_least_of(chunk.hashes(length), window - length + 1) * _M1), buckets)


def _known(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of the keys are in the sorted ``among``; neighbours are often equal and looked up once."""
    if not len(among) or not len(keys):
        return np.zeros(len(keys), dtype=bool)
    at = runs(keys)
    own = keys[at]
    found = among[np.minimum(np.searchsorted(among, own), len(among) - 1)] == own
    return np.repeat(found, np.diff(at, append=len(keys)))


def last_level(chunk: Chunk, window: int, at: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """(order, group of each in that order, hash, second hash, least id, bucket) of the distinct windows at ``at``."""
    a, b = chunk.hashes(window)[at], (chunk.hashes(window, 1)[at] >> _U(32)).astype(np.uint32)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    starts = runs(a, b)
    ids = chunk.ids[chunk.doc[at[order]]]
    group = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(at)))
    return order, group, a[starts], b[starts], np.minimum.reduceat(ids, starts), (a[starts] >> _U(32)) * _U(buckets) >> _U(32)


def chunked(spark: SparkSession, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The corpus as a stored table of chunks (chunk, n_words, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = serials()
        ids, counts, texts = [], [], []

        def flushed() -> pa.RecordBatch:
            known = np.array([i is not None for i in ids], dtype=np.uint8)
            data = pack(np.array([i or 0 for i in ids], dtype=np.int64), known, least_width(np.array(counts, dtype=np.int64)),
                        np.frombuffer(b"\n".join(texts), dtype=np.uint8))
            out = pa.RecordBatch.from_pydict({"chunk": [next(number)], "n_words": [sum(counts)], "data": [data]})
            ids.clear(), counts.clear(), texts.clear()
            return out

        held = 0
        for i, t in rows(batches):
            words = (t or b"").split()
            ids.append(i)
            counts.append(len(words))
            texts.append(b" ".join(words))
            held += len(words) + 1
            if held >= CHUNK_WORDS:
                yield flushed()
                held = 0
        if ids:
            yield flushed()

    narrow = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    return materialize(spark, narrow.mapInArrow(run, "chunk long, n_words long, data binary"), "substring-chunks", "none")


_BLOCK = "bucket int, chunk long, data binary"


def _block(bucket: int, chunk: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([chunk], pa.int64()), pa.array([data], pa.binary())],
                                      names=["bucket", "chunk", "data"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, bytes], bytes]]:
    """(chunk, its replies by bucket, its data) of rows by chunk."""
    for chunk, held in groups(batches):
        yield chunk, {part: data for part, data in held if part is not None}, next(data for part, data in held if part is None)


def _repeated(replies: dict[int, bytes]) -> np.ndarray:
    parts = [_U(bucket << 32) | unpack(data)[0].astype(np.uint64) for bucket, data in sorted(replies.items()) if bucket >= 0]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, n_words, n_removed and ``text``, the kept words joined by one space."""
    if window < 1:
        raise ValueError("a window has at least one word")
    ship(spark)
    bound_batches(spark)
    chunks = chunked(spark, docs, doc_id, text)
    buckets = 1 + (chunks.agg(F.sum("n_words").alias("n")).first()["n"] or 0) // BUCKET_WORDS
    lengths = ladder(window)

    def send(length: int, before: int | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, replies, data in _met(batches):
                chunk = Chunk(data)
                at = survivors(chunk, window, buckets, _repeated(replies), before)
                if not len(at):
                    continue
                if length == window:
                    _, _, a, b, least, bucket = last_level(chunk, window, at, buckets)
                    for k, own in cut_by(bucket):
                        base = least[own].min()
                        # Differences of ids are taken without a sign, so that ids of any size fit.
                        yield _block(k, number, pack(a[own], b[own], np.array([base]), least_width(least[own].view(np.uint64) - base.view(np.uint64))))
                    continue
                keys, doc = _stand_ins(chunk, window, length, buckets)[at], chunk.doc[at]
                first = runs(keys, doc)
                keys, doc = keys[first], doc[first]
                order = np.argsort(keys, kind="stable")
                keys, doc = keys[order], doc[order]
                starts = runs(keys)
                stops = np.append(starts[1:], len(keys)) - 1
                several, keys = doc[starts] != doc[stops], keys[starts]
                for k, own in cut_by(keys >> _U(32)):
                    yield _block(k, number, pack(keys[own].astype(np.uint32), np.packbits(several[own])))
        return run

    def judge_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in groups(batches):
            blocks = [(chunk, *unpack(data)) for chunk, data in held]
            keys = np.concatenate([b[1] for b in blocks])
            several = np.concatenate([np.unpackbits(b[2], count=len(b[1])) for b in blocks]).astype(bool)
            found, number, n = np.unique(keys, return_inverse=True, return_counts=True)
            again = n > 1
            again[number[several]] = True
            again, at = again[number], 0
            for chunk, own, _ in blocks:
                if (stays := own[again[at:at + len(own)]]).size:
                    yield _block(bucket, chunk, pack(stays))
                at += len(own)

    def judge_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in groups(batches):
            blocks = [(chunk, *unpack(data)) for chunk, data in held]
            a, b = np.concatenate([x[1] for x in blocks]), np.concatenate([x[2] for x in blocks])
            ids = np.concatenate([(x[4].astype(np.uint64) + x[3].view(np.uint64)).view(np.int64) for x in blocks])
            order = np.lexsort((b, a))
            starts = runs(a[order], b[order])
            least = np.minimum.reduceat(ids[order], starts)
            smaller = np.empty(len(ids), dtype=bool)
            smaller[order] = np.repeat(least, np.diff(starts, append=len(ids))) < ids[order]
            at = 0
            for chunk, own, *_ in blocks:
                # Buckets of the last level are told from those of the level before by their sign.
                yield _block(-1 - bucket, chunk, pack(np.packbits(smaller[at:at + len(own)])))
                at += len(own)

    nothing = spark.createDataFrame([], _BLOCK)
    replies, before = nothing, None
    for length in lengths:
        sent = by_chunk(chunks, replies).mapInArrow(send(length, before), _BLOCK) if before else \
            chunks.select("chunk", F.lit(None).cast("int").alias("part"), "data").mapInArrow(send(length, None), _BLOCK)
        judged = by_bucket(sent, buckets).mapInArrow(judge_last if length == window else judge_level, _BLOCK)
        judged = materialize(spark, judged, f"substring-level-{length}", "none")
        if length == window:
            replies = replies.unionByName(judged)
        else:
            replies, before = judged, length

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, answers, data in _met(batches):
            chunk = Chunk(data)
            covered = np.zeros(len(chunk.doc) + 1, dtype=np.int32)
            at = survivors(chunk, window, buckets, _repeated(answers), before)
            if len(at):
                order, group, _, _, least, bucket = last_level(chunk, window, at, buckets)
                elsewhere = np.concatenate([np.unpackbits(unpack(answers[-1 - k])[0], count=own.stop - own.start) for k, own in cut_by(bucket)]).astype(bool)
                gone = at[order][elsewhere[group] | (chunk.ids[chunk.doc[at[order]]] > least[group])]
                np.add.at(covered, gone, 1)
                np.subtract.at(covered, gone + window, 1)
            drop = np.cumsum(covered[:-1]) > 0
            removed = np.bincount(chunk.doc[drop], minlength=len(chunk.ids))
            ends = np.cumsum(chunk.counts)
            kept, size, start = [], 0, 0
            for k, t in enumerate(chunk.text.split(b"\n")):
                if removed[k]:
                    t = b" ".join(compress(t.split(b" "), (~drop[ends[k] - chunk.counts[k]:ends[k]]).tolist()))
                kept.append(t)
                size += len(t)
                if size >= _OUT_BYTES or k + 1 == len(chunk.ids):
                    own = slice(start, k + 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(chunk.ids[own], mask=~chunk.known[own]), pa.array(chunk.counts[own]), pa.array(removed[own].astype(np.int64)),
                         pa.array(kept, pa.binary()).cast(pa.string())], names=[doc_id, "n_words", "n_removed", text])
                    kept, size, start = [], 0, k + 1

    return by_chunk(chunks, replies).mapInArrow(rewrite, f"`{doc_id}` long, n_words long, n_removed long, `{text}` string")
