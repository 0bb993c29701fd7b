"""Operator 12, collocations: phrases that stand together more often than their parts do, from FM-indexes.

Texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs; A-Z is
folded. Counts are kept per language. Each shard of about ``SHARD_WORDS`` words of one language
holds an FM-index over word ids: the Burrows-Wheeler transform of its pieces, their suffixes
sorted by their first ``longest`` words (deeper order is not needed for phrases up to that length).

Enumeration goes by length. The rows of the index that start with a frequent phrase p are an
interval; the words before them (the transform) extend p to the left, and the rows that each
extension c p comes to are again an interval, found by the rank of c. That interval lies within that of
c p without its last word, of which c p is the extension to the right: it is kept only if that phrase
is frequent, too. So each phrase is reached from both sides at once, as (prefix, suffix), and a shard
steps all intervals of a length at once. Counts of a length are summed over the shards, those under
``least`` are dropped, and the shards learn which of their intervals go on. Words under ``least``
break pieces, since no phrase that counts holds them.

A phrase of 2 to ``longest`` words is cut into two parts at the place with the least
floor(scale * a * n / (l * r)): a, l, r the counts of the phrase and the parts, n that of all words.
A phrase inside a longer one with ``100 * f(longer) >= absorb * a`` is dropped; of the longer ones
those by one word decide, as none that hold them are more frequent.

A null text is empty, a null language is ``und``. Empty texts, texts of separators and repeated rows
need no care: they count as they stand. A piece of any length is indexed whole; a shard holds at least
one piece. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.blocks import by_bucket, by_chunk, cut_by, groups, least_width, pack, rows, runs, serials, unpack
from tripflow.llm.common import bound_batches, materialize, rank_rows, ship

SHARD_WORDS = 1 << 20
BUCKET_WORDS = 1 << 21  # of the corpus for each bucket of phrases
#: A-Z folded, the signs that end a piece become line feeds.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0B\x0C\x0D", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)

_SENT = "bucket int, chunk long, data binary"
_JUDGED = "kind string, bucket int, chunk long, data binary, gid long, prefix long, suffix long, lang string, phrase string, f long"


class _Words(dict):
    """Word -> number from 1 on, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + 1
        return n


def sharded(spark: SparkSession, docs: DataFrame, lang: str, text: str) -> DataFrame:
    """The corpus as a stored table of shards (chunk, lang, n_words, data): word numbers with a 0 before each piece, and the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, total = serials(), {}, 0

        def flushed(of: str) -> pa.RecordBatch:
            words, parts, _ = held.pop(of)
            ids = np.concatenate(parts)
            data = pack(least_width(ids), np.frombuffer(b"\n".join(words), dtype=np.uint8))
            return pa.RecordBatch.from_arrays([pa.array([next(number)], pa.int64()), pa.array([of]), pa.array([int((ids > 0).sum())], pa.int64()),
                                               pa.array([data], pa.binary())], names=["chunk", "lang", "n_words", "data"])

        for of, t in rows(batches):
            if of not in held:
                held[of] = [_Words(), [], 0]
            own = held[of]
            ids, learn = [], own[0].__getitem__
            for piece in t.translate(_FOLD).split(b"\n"):
                if words := piece.split():
                    ids.append(0)
                    ids.extend(map(learn, words))
            if ids:
                own[1].append(np.array(ids, dtype=np.int64))
                own[2] += len(ids)
                total += len(ids)
            # Many languages at once share the room of two shards.
            full = of if own[2] >= SHARD_WORDS else max(held, key=lambda k: held[k][2]) if total >= 2 * SHARD_WORDS else None
            if full is not None:
                total -= held[full][2]
                yield flushed(full)
        for of in [k for k in held if held[k][2]]:
            yield flushed(of)

    narrow = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    return materialize(spark, narrow.mapInArrow(run, "chunk long, lang string, n_words long, data binary"), "phrase-shards", "none")


def _vocabulary(data: bytes, lang: str, buckets: int) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(word numbers of the shard, its words, and by bucket: the words' places in order of their bucket, those buckets)."""
    ids, text = unpack(data)
    words = text.tobytes().split(b"\n")
    salt = zlib.crc32(lang.encode())
    bucket = np.fromiter((zlib.crc32(w, salt) for w in words), dtype=np.int64, count=len(words)) * buckets >> 32
    order = np.argsort(bucket, kind="stable")
    return ids.astype(np.int64), words, order, bucket[order]


def index(ids: np.ndarray, depth: int) -> np.ndarray:
    """The words before the suffixes of ``ids`` sorted by their first ``depth`` words (their first words are the same, sorted).

    Ranks by 1, 2, 4, ... words are made of pairs of the ranks before.
    """
    n, rank, known = len(ids), np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while known < depth:
        step = min(known, depth - known)
        key = rank * (int(rank.max()) + 2)
        key[:n - step] += rank[step:] + 1
        known += step
        if known < depth:
            rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(key if depth > 1 else rank, kind="stable")
    return ids[order - 1]


def extend(before: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step to the left of all labelled intervals: (prefix, suffix, count, start) of the phrases one word longer.

    ``label`` has for each row of the index the frequent phrase that its suffix starts with, or -1. Row j of the
    index is the extension by its first word of the row that stands j-th if rows are ordered by the word before.
    """
    suffix = label[np.argsort(before, kind="stable")]
    at = np.flatnonzero((suffix >= 0) & (label >= 0))
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    prefix, suffix = label[at], suffix[at]
    starts = runs(prefix, suffix)
    return prefix[starts], suffix[starts], np.diff(starts, append=len(at)), at[starts]


def _spread(prefix: np.ndarray, suffix: np.ndarray, buckets: int) -> np.ndarray:
    h = (prefix.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (suffix.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _row(bucket: int | None, chunk: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([chunk], pa.int64()), pa.array([data], pa.binary())],
                                      names=["bucket", "chunk", "data"])


def _grams(gid, prefix, suffix, lang, phrase, f) -> pa.RecordBatch:
    n = len(gid)
    return pa.RecordBatch.from_arrays(
        [pa.array(["gram"] * n), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(gid, pa.int64()),
         pa.nulls(n, pa.int64()) if prefix is None else pa.array(prefix), pa.nulls(n, pa.int64()) if suffix is None else pa.array(suffix),
         pa.nulls(n, pa.string()) if lang is None else pa.array(lang, pa.string()),
         pa.nulls(n, pa.string()) if phrase is None else pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(f, pa.int64())],
        names=["kind", "bucket", "chunk", "data", "gid", "prefix", "suffix", "lang", "phrase", "f"])


def _reply(bucket: int, chunk: int, data: bytes) -> pa.RecordBatch:
    b = _row(bucket, chunk, data)
    n = pa.nulls(1, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(["reply"]), *b.columns, n, n, n, pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), n],
                                      names=["kind", "bucket", "chunk", "data", "gid", "prefix", "suffix", "lang", "phrase", "f"])


def _blocks(before: np.ndarray, label: np.ndarray, chunk: int, buckets: int) -> Iterator[pa.RecordBatch]:
    prefix, suffix, count, start = extend(before, label)
    bucket = _spread(prefix, suffix, buckets)
    order = np.argsort(bucket, kind="stable")
    for k, own in cut_by(bucket[order]):
        at = order[own]
        yield _row(k, chunk, pack(prefix[at], suffix[at], least_width(count[at]), least_width(np.diff(start[at], prepend=0))))


def frequent(spark: SparkSession, docs: DataFrame, longest: int = 5, least: int = 100, lang: str = "lang", text: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n: number of words), and for each length from 1 to ``longest`` (less, if no phrase is that long) a stored table of the
    phrases counted ``least`` times: gid, prefix, suffix (gids of the phrases without the last and without the first word), f, and for single words lang and phrase."""
    ship(spark)
    bound_batches(spark)
    shards = sharded(spark, docs, lang, text)
    totals = materialize(spark, shards.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-totals")
    buckets = 1 + (totals.agg(F.sum("n").alias("n")).first()["n"] or 0) // BUCKET_WORDS

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, of, data in rows(batches):
            ids, words, order, bucket = _vocabulary(data, of, buckets)
            n = np.bincount(ids, minlength=len(words) + 1)[1:]
            for k, own in cut_by(bucket):
                at = order[own]
                listed = b"\n".join([of.encode().hex().encode(), *[words[i] for i in at.tolist()]])
                yield _row(k, chunk, pack(least_width(n[at]), np.frombuffer(listed, dtype=np.uint8)))

    def judge_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in groups(batches):
            blocks, total = [], {}
            for chunk, data in held:
                n, text = unpack(data)
                of, *words = text.tobytes().split(b"\n")
                own = total.setdefault(of, {})
                for w, x in zip(words, n.tolist()):
                    own[w] = own.get(w, 0) + x
                blocks.append((chunk, of, words))
            gid = bucket << 32
            number: dict[bytes, dict[bytes, int]] = {}
            for of, own in total.items():
                kept = [w for w, x in own.items() if x >= least]
                number[of] = dict(zip(kept, range(gid, gid + len(kept))))
                if kept:
                    yield _grams(list(number[of].values()), None, None, [bytes.fromhex(of.decode()).decode()] * len(kept), kept, [own[w] for w in kept])
                gid += len(kept)
            for chunk, of, words in blocks:
                yield _reply(bucket, chunk, pack(np.array([number[of].get(w, -1) for w in words], dtype=np.int64)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, held in groups(batches):
            of, data = next((of, data) for part, of, data in held if part is None)
            replies = {part: data for part, _, data in held if part is not None}
            ids, words, order, bucket = _vocabulary(data, of, buckets)
            gid = np.full(len(words) + 1, -1, dtype=np.int64)
            for k, own in cut_by(bucket):
                gid[order[own] + 1] = unpack(replies[k])[0]
            known = gid >= 0
            if not known.any():
                continue
            local = np.cumsum(known) * known  # numbers of the frequent words; 0 stands between pieces
            ids = local[ids]
            ids = ids[(ids > 0) | (np.append(ids[1:], 0) > 0)]
            yield _row(None, chunk, pack(least_width(index(np.append(ids, 0), longest)), gid[known]))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, data in rows(batches):
            before, gid = unpack(data)
            yield from _blocks(before, np.append(-1, gid)[np.sort(before)], chunk, buckets)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in groups(batches):
            blocks = [(chunk, *unpack(data)) for chunk, data in held]
            prefix, suffix = np.concatenate([b[1] for b in blocks]), np.concatenate([b[2] for b in blocks])
            count = np.concatenate([b[3] for b in blocks]).astype(np.int64)
            order = np.lexsort((suffix, prefix))
            starts = runs(prefix[order], suffix[order])
            f = np.add.reduceat(count[order], starts)
            stays = f >= least
            if not stays.any():
                continue
            gids = np.where(stays, (bucket << 32) + np.cumsum(stays) - 1, -1)
            yield _grams(gids[stays], prefix[order][starts][stays], suffix[order][starts][stays], None, None, f[stays])
            gid = np.empty(len(order), dtype=np.int64)
            gid[order] = np.repeat(gids, np.diff(starts, append=len(order)))
            at = 0
            for chunk, own, _, n, start in blocks:
                g = gid[at:at + len(own)]
                at += len(own)
                if (keep := g >= 0).any():
                    yield _reply(bucket, chunk, pack(g[keep], n[keep], np.cumsum(start.astype(np.int64))[keep]))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, held in groups(batches):
            replies = [unpack(data) for part, data in held if part is not None]
            if not replies:
                continue
            before = unpack(next(data for part, data in held if part is None))[0]
            label = np.full(len(before), -1, dtype=np.int64)
            for gid, n, start in replies:
                n = n.astype(np.int64)
                ends = np.cumsum(n)
                label[np.repeat(start - (ends - n), n) + np.arange(ends[-1])] = np.repeat(gid, n)
            yield from _blocks(before, label, chunk, buckets)

    def judged(blocks: DataFrame, by, name: str) -> tuple[DataFrame, DataFrame]:
        own = by_bucket(blocks, buckets).mapInArrow(by, _JUDGED)
        own = materialize(spark, own, name, "none")
        return own.where("kind = 'gram'").drop("kind", "bucket", "chunk", "data"), own.where("kind = 'reply'").select("bucket", "chunk", "data")

    words, replies = judged(shards.select("chunk", "lang", "data").mapInArrow(count_words, _SENT), judge_words, "phrase-words")
    out = [words.drop("prefix", "suffix")]
    if longest < 2:
        return totals, out
    with_lang = (replies.select("chunk", F.col("bucket").alias("part"), F.lit(None).cast("string").alias("lang"), "data")
                 .unionByName(shards.select("chunk", F.lit(None).cast("int").alias("part"), "lang", "data"))
                 .repartition("chunk").sortWithinPartitions("chunk", F.col("part").asc_nulls_last()))
    indexes = materialize(spark, with_lang.mapInArrow(build, _SENT).select("chunk", "data"), "phrase-index", "none")
    blocks = indexes.mapInArrow(pairs, _SENT)
    for length in range(2, longest + 1):
        grams, replies = judged(blocks, judge, f"phrases-{length}")
        if grams.isEmpty():
            break
        out.append(grams.drop("lang", "phrase"))
        blocks = by_chunk(indexes, replies).mapInArrow(step, _SENT)
    return totals, out


def collocations(spark: SparkSession, docs: DataFrame, top: int | None = 2000, longest: int = 5, least: int = 100, scale: int = 1000,
                 absorb: int = 100, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of each language (of all, for None):
    by score and a descending, then by the phrase's bytes."""
    totals, levels = frequent(spark, docs, longest, least, lang, text)
    counts = F.array("f")
    held = levels[0].select("gid", "lang", "f", F.col("phrase").alias("first"), "phrase", counts.alias("heads"), counts.alias("tails"))
    phrases = []
    for grams in levels[1:]:
        left = held.select(F.col("gid").alias("prefix"), "lang", "first", "heads")
        right = held.select(F.col("gid").alias("suffix"), "phrase", "tails")
        held = (grams.join(left, "prefix").join(right, "suffix")
                .select("gid", "prefix", "suffix", "lang", "f", "first", F.concat_ws(" ", "first", "phrase").alias("phrase"),
                        F.concat("heads", counts).alias("heads"), F.concat("tails", counts).alias("tails")))
        held = materialize(spark, held, "phrase-texts")
        phrases.append(held)

    whole = "decimal(18,0)"
    out = None
    for k, own in enumerate(phrases):
        if k + 1 < len(phrases):
            longer = phrases[k + 1]
            around = (longer.select(F.col("prefix").alias("gid"), "f").unionByName(longer.select(F.col("suffix").alias("gid"), "f"))
                      .groupBy("gid").agg(F.max("f").alias("longer")))
            own = own.join(around, "gid", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < absorb * F.col("f")))
        size = k + 2
        of = own.join(totals, "lang")
        cuts = []
        for cut in range(1, size):
            l, r = F.element_at("heads", cut), F.element_at("tails", size - cut)
            score = F.expr(f"(CAST(f AS {whole}) * CAST(n AS {whole}) * {scale}BD) div (CAST(heads[{cut - 1}] AS {whole}) * CAST(tails[{size - cut - 1}] AS {whole}))")
            cuts.append(F.struct(score.cast("long").alias("score"), F.lit(cut).alias("cut"), l.alias("l"), r.alias("r")))
        scored = of.select("lang", "phrase", F.col("f").alias("a"), F.array_min(F.array(*cuts)).alias("cut"), "n")
        out = scored if out is None else out.unionByName(scored)
    shape = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
    if out is None:
        return spark.createDataFrame([], shape)
    scored = materialize(spark, out.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), "phrase-scores")
    # Ranked over range partitions: a language with most of the phrases is no single task.
    ranked = rank_rows(spark, scored, [F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")], "phrase-ranks")
    firsts = ranked.groupBy("lang").agg(F.min("row_no").alias("first_row"))
    ranked = ranked.join(firsts, "lang").withColumn("rank", F.col("row_no") - F.col("first_row") + 1)
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
